"""Quality selection by importance resampling.

Words and word pairs are hashed into `BUCKETS`; a generative model is the
bucket distribution of a set of texts. A document's log importance weight is
the sum, over its n-grams, of log target(bucket) - log raw(bucket). Adding
independent Gumbel noise and keeping the k largest keys draws k documents
without replacement with probability in proportion to their weights.

The raw model counts all documents; the target model counts a bounded sample
(`SAMPLE` rows, by hash order) of the documents labelled good. Only bucket
totals reach the driver. Ranks come from range-partitioned prefix sums, so the
top k is exact and no task holds it.

Defined results: a null text is an empty one, with weight 0; the noise is a
function of the id, so reruns agree; rows that share an id share their noise;
labels with null id or value are ignored; without target texts every weight is
0; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordered_totals
from .mixing import uniform
from .text import SPACED, rolled, sliced, text_bytes, words

BUCKETS, SAMPLE, SHARE, SEED = 10_000, 20_000, 0.85, "resample"


def ngram_buckets(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and word pair."""
    data, offsets = text_bytes(column)
    _, _, hashes, first = words(data, offsets, SPACED)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    pairs, inside = rolled(hashes, 2), row[1:] == row[:-1]
    both = np.concatenate([hashes, pairs[inside]])
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[1:][inside]])


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """n-grams of all rows of `texts` (text) per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in sliced(batches, 0):
            total += np.bincount(ngram_buckets(batch.column(0), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for row in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log target(bucket) - log raw(bucket), with one added count in each."""
    if not target.sum():
        return np.zeros(len(raw))
    share = lambda n: (n + 1) / (n.sum() + len(n))
    return np.log(share(target)) - np.log(share(raw))


def _weighed(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            bucket, row = ngram_buckets(batch.column(1), len(ratio))
            weight = np.bincount(row, weights=ratio[bucket], minlength=batch.num_rows)
            n = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(weight)], ["id", "n_ngrams", "log_weight"])

    return run


def resampled(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    *, share: float = SHARE, buckets: int = BUCKETS, sample: int = SAMPLE, seed: str = SEED,
) -> DataFrame:
    """One row per row of `docs`: id_col, n_ngrams, log_weight, key, rank (0 is
    the largest key) and kept (rank below share * rows)."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    good = labels.where(F.col(id_col).isNotNull() & (F.col(label_col) > 0)).select(F.col(id_col).alias("id")).distinct()
    good = good.orderBy(F.xxhash64("id"), "id").limit(sample)
    target = bucket_counts(narrow.join(F.broadcast(good), "id", "left_semi").select("text"), buckets)  # at most `sample` ids
    ratio = log_ratio(target, bucket_counts(narrow.select("text"), buckets))
    weighed = narrow.mapInArrow(_weighed(ratio), f"id {kind}, n_ngrams long, log_weight double")
    noise = -F.log(-F.log(uniform(F.col("id"), seed)))
    keyed = weighed.withColumn("key", F.col("log_weight") + noise)
    ranked = ordered_totals(keyed, [F.col("key").desc(), F.col("id"), F.col("n_ngrams")], "rank")
    rows = docs.count()
    kept = F.col("rank") < F.lit(int(np.ceil(share * rows)))
    return ranked.select(F.col("id").alias(id_col), "n_ngrams", "log_weight", "key", "rank", kept.alias("kept"))


def selected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that the resampling keeps."""
    kept = resampled(docs, labels, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("__id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
