"""Importance resampling towards a target distribution, over hashed word n-grams.

A 256-byte table lower-cases A-Z and turns every separator byte of the UTF-8
text into a space; `bytes.split` then yields the words. An n-gram is its words
joined by one space, and its hash is a chain of CRC-32: the hash of the first
n - 1 words seeds that of " " + the last word, so each level costs one call per
word. Counters reduce hashes to buckets.

    gain(bucket) = floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))

with s of S features of all documents and t of T features of the target texts.
A document's weight is the floored mean gain of its features, its score adds
Gumbel noise drawn from its id, and the documents with the highest scores are
drawn: a sample without replacement in proportion to the weights.

Both models count all texts; only the totals of the fixed number of buckets
reach the driver. Scores are written once and ranked by range-partitioned
prefix sums, so the draw is exact and no task holds it.

Defined results: a null text has no words; a document without words has weight
0; a null id draws the noise of an empty id and sorts first among equal scores;
rows that share an id share their noise, and among equal scores those with fewer
features come first; without target texts every gain follows from t = T = 0;
extra columns are ignored; an empty table gives an empty result. The columns
n_words, __short and __place are the operator's own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordered_totals
from ..sources.scratch import materialize
from .text import sliced, text_bytes

BUCKETS, WORDS, SEED = 10_000, 1, 2024
#: Documents of fewer words are not drawn; of the others, this percentage is.
LEAST, PERCENT = 20, 10
#: Bytes of text that are words at a time.
PIECE = 1 << 20

_SPACE = 0x20
#: Letters, digits and all bytes beyond ASCII stay, A-Z as a-z; every other byte is a space.
TABLE = bytes(b if b >= 0x80 or bytes([b]).isalnum() else _SPACE for b in bytes(range(256)).lower())


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about `PIECE` bytes; no word is cut."""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].translate(TABLE)
        at += len(piece)
        while at < len(text) and piece[-1] != _SPACE:
            more = text[at : at + 4096].translate(TABLE)
            end = more.find(b" ") + 1 or len(more)
            piece, at = piece + more[:end], at + end
        yield piece.split()


def hashed(words: list[bytes], longest: int) -> Counter:
    """How often each n-gram hash occurs in a list of words, for n up to `longest`."""
    seeds = list(map(crc32, words))
    counts = Counter(seeds)
    spaced = [b" " + word for word in words] if longest > 1 else []
    for n in range(1, min(longest, len(words))):
        seeds = list(map(crc32, spaced[n:], seeds))
        counts.update(seeds)
    return counts


def features(text: bytes, longest: int = WORDS) -> tuple[int, Counter]:
    """(number of words, how often each n-gram hash occurs) of one text."""
    words, counts, last = 0, Counter(), []
    for piece in word_pieces(text):
        words += len(piece)
        counts.update(hashed(last + piece, longest))
        if longest > 1:
            if last:  # what lies wholly in the words carried over was counted before
                counts.subtract(hashed(last, longest))
            last = (last + piece)[1 - longest :]
    return words, counts


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_bytes(column)
    whole, cuts = memoryview(data), offsets.tolist()
    return (bytes(whole[a:b]) for a, b in zip(cuts, cuts[1:]))


def bucket_totals(texts: DataFrame, longest: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of `texts` (text) per bucket: one long per bucket on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in sliced(batches, 0):
            for text in _texts(batch.column(0)):
                counts = features(text, longest)[1]
                at = np.fromiter(counts.keys(), np.int64, len(counts)) % buckets
                total += np.bincount(at, np.fromiter(counts.values(), np.int64, len(counts)), buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for row in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket, in thousandths."""
    s_all, t_all, size = float(raw.sum()), float(target.sum()), float(len(raw))
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for s, t in zip(raw.astype(float), target.astype(float))],
        dtype=np.int64,
    )


def _weighed(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = gain.tolist()
        for batch in sliced(batches, 1):
            rows = []
            for text in _texts(batch.column(1)):
                words, counts = features(text, longest)
                n = counts.total()
                rows.append((words, n, sum(of[h % len(of)] * c for h, c in counts.items()) // n if n else 0))
            columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_words", "n_features", "weight"])

    return run


def gumbel(id_: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id, in thousandths: from the first 32 bits of a SHA-256 of seed and id."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    *, words: int = WORDS, buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: id_col, n_features, weight, score and rank.

    Features are all runs of 1 to `words` consecutive words. Of the N documents
    with at least `least` words, floor(percent * N / 100) are drawn; rank counts
    them from 1 by falling score (then by id), and is null for all others.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    wanted = bucket_totals(target.select(F.col(f"`{target_col}`").alias("text")), words, buckets)
    gain = gains(bucket_totals(narrow.select("text"), words, buckets), wanted)
    weighed = narrow.mapInArrow(_weighed(gain, words), f"id {kind}, n_words long, n_features long, weight long")
    scored = weighed.select("*", (F.col("weight") + gumbel(F.col("id"), seed)).cast("long").alias("score"))
    scored = materialize(scored.withColumn("__short", F.col("n_words") < least), "scored")
    drawn = F.floor(scored.agg(F.count_if(~F.col("__short"))).scalar() * F.lit(percent) / 100)
    order = [F.col("__short"), F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("n_features"), F.col("weight")]
    ranked = ordered_totals(scored, order, "__place")
    rank = F.when(~F.col("__short") & (F.col("__place") < drawn), F.col("__place") + 1).cast("long")
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"))


def selected(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents drawn, with all their columns; rows that share a drawn id stay together."""
    drawn = resampled(docs, target, id_col, text_col, **options).where(F.col("rank").isNotNull())
    ids = drawn.select(F.col(f"`{id_col}`").alias("__id")).distinct()
    return docs.join(ids, docs[f"`{id_col}`"].eqNullSafe(F.col("__id")), "left_semi")
