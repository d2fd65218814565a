"""Document fingerprints by a threshold-scaled sketch.

A text's sketch keeps every word-shingle hash below a fixed fraction of the
hash range, so its size follows the text's and sketches of very unequal texts
stay comparable: the retained hashes of a union are the union of the retained
hashes, and both resemblance and containment are estimated from them.

A fingerprint is "n:digest:hashes": the number of distinct shingles, a digest
of the whole set, and the retained hashes, ascending, 16 hex digits each.
Equal texts have equal fingerprints. Two fingerprints of the same set have
likeness 1; otherwise likeness is the Jaccard index of the retained hashes (0
where neither retains any).

Defined results: a null text is an empty one, with the fingerprint "0:" and an
empty set; texts of fewer words than a shingle have their whole word sequence
as one shingle; in `edited` rows are ordered by id (null first), then text, and
a single row is its own successor; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import mix, sliced, text_shingles

WORDS = 5
#: One of so many shingle hashes is retained.
SCALE = 2
NO_ID = -(1 << 63)


def retained(items: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return items[items < np.uint64((1 << 64) // scale)]


def fingerprint(items: np.ndarray, scale: int = SCALE) -> str:
    """`items`: the text's distinct shingle hashes, ascending."""
    if not len(items):
        return "0:"
    digest = int(mix(items.copy()).sum(dtype=np.uint64))
    return f"{len(items)}:{digest:016x}:{retained(items, scale).astype('>u8').tobytes().hex()}"


def parsed(text: str) -> tuple[str, np.ndarray]:
    """(identity, retained hashes) of a fingerprint."""
    head, _, hashes = text.rpartition(":")
    return head, np.frombuffer(bytes.fromhex(hashes), ">u8").astype(np.uint64)


def merged(fingerprints: list[str]) -> np.ndarray:
    """Retained hashes of the union of the fingerprinted texts."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(parsed(f)[1] for f in fingerprints)]))


def likeness(a: str, b: str) -> float:
    return _alike(*parsed(a), *parsed(b))[0]


def containment(a: str, b: str) -> float:
    """Estimated share of a's shingles that b has."""
    return _alike(*parsed(a), *parsed(b))[1]


def _alike(a_head: str, a: np.ndarray, b_head: str, b: np.ndarray) -> tuple[float, float]:
    if a_head == b_head:
        return 1.0, 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return (shared / union if union else 0.0), (shared / len(a) if len(a) else 0.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """(id_col, fingerprint) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            prints = [fingerprint(items, scale) for items in text_shingles(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], [id_col, "fingerprint"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fingerprint string"
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, schema)


def ranges(docs: DataFrame, parts: int) -> DataFrame:
    """`docs` (id, place, text) with `part`, rising with `place`, of nearly equal row counts."""
    bounds = docs.approxQuantile("place", [i / parts for i in range(1, parts)], 0.1 / parts)
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    if len(splits) < 3:
        return docs.withColumn("part", F.lit(0))
    dealt = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(docs.withColumn("place", F.col("place").cast("double")))
    return dealt.withColumn("part", F.col("bucket").cast("int")).drop("bucket")


def with_successors(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, id, text, ghost), sorted inside tasks so that a row's
    successor is the row below it. Each part ends with a ghost: the first row
    of the next part, or of the table."""
    place = F.coalesce(F.col("id").cast("long"), F.lit(NO_ID))
    rows = ranges(docs.withColumn("place", place.cast("double")), parts).select("part", "id", "text")
    key = F.struct(F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("place"), F.col("text").alias("text"))
    firsts = rows.groupBy("part").agg(F.min(key).alias("low"))
    order = Window.orderBy("part")  # one row per part
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ghosts = firsts.select("part", F.coalesce(F.lead("low").over(order), F.first("low").over(whole)).alias("next"))
    ghosts = ghosts.select("part", F.lit(None).cast("long").alias("id"), F.col("next.text").alias("text"), F.lit(1).alias("ghost"))
    both = rows.select("part", F.col("id").cast("long"), "text", F.lit(0).alias("ghost")).unionByName(ghosts)
    return both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "ghost", F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())


def edited_text(text: str, successor: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of the successor."""
    half = len(text) // 2
    return text[: len(text) - half] + successor[:half]


RESULT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, contained_next double"


def _compared(words: int, scale: int):
    def sketches(texts: list[str]) -> list[tuple[str, str, np.ndarray]]:
        out = []
        for items in text_shingles(pa.array(texts, pa.large_string()), words):
            mark = fingerprint(items, scale)
            out.append((mark, mark.rpartition(":")[0], retained(items, scale)))
        return out

    def compared(ids: list, texts: list[str], last: str) -> pa.RecordBatch:
        edits = [edited_text(a, b) for a, b in zip(texts, [*texts[1:], last])]
        own, new = sketches([*texts, last]), sketches(edits)
        near = [_alike(*a[1:], *b[1:]) for a, b in zip(own, new)]
        after = [_alike(*a[1:], *b[1:]) for a, b in zip(own, own[1:])]
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits]),
            pa.array([o[0] for o in own[:-1]]),
            pa.array([o[0] for o in new]),
            *(pa.array([pair[i] for pair in pairs], pa.float64()) for i in (0, 1) for pairs in (near, after)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained_edited", "contained_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for key, text, ghost in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("ghost").to_pylist()):
                text = text.as_py() or ""
                if texts and (ghost or size > (2 << 20)):
                    yield compared(ids, texts, text)
                    ids, texts, size = [], [], 0
                if not ghost:
                    ids.append(key)
                    texts.append(text)
                    size += len(text)

    return run


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """Each document's fingerprint, that of its edited text (last half replaced
    by the start of the next document), and likeness and containment to the
    edited text and to the next document. The text is shuffled once."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_successors(narrow, parts).mapInArrow(_compared(words, scale), RESULT)
