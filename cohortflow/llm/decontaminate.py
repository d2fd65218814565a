r"""Benchmark decontamination by a broadcast hash set of normalised windows.

Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after folding A-Z. Every run of
`WINDOW` consecutive words of a benchmark item is a window; an item of fewer
words, but not none, is one window. A window is its length, a rolled hash that
finds it and the SHA-256 of its words that verifies it.

* The (window, item) pairs are dealt to blocks of at most `BLOCK` pairs by both
  window and item, so that a window of very many items fills no block alone.
  Each block is broadcast, and every document is scanned whole in one pass per
  block, without a shuffle.
* A benchmark of more than `CHAIN` blocks is joined instead: a bit table of
  bounded size drops most positions in place, and what passes is joined with the
  windows, then the distinct verified hits with their items.

Defined results: null and empty texts have no words and no hits; benchmark rows
without id, text or words are no items; repeated benchmark rows are one item;
an empty benchmark hits nothing; extra columns pass through untouched and may
have any name that does not start with `__bench_`.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .membership import bit_table, passing
from .text import ALNUM, FOLD, map_rows, rolled, sliced, text_bytes, words

WINDOW = 10
#: (window, item) pairs in one broadcast: 44 bytes and the item's id each.
BLOCK = 200_000
#: Blocks that are broadcast; a larger benchmark is joined.
CHAIN = 4
_BITS = 22
PAIR = "item string, length int, roll long, digest binary"
RESULT = "array<struct<first:int,last:int,start:int,end:int>>"
SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _digest(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, length: int) -> bytes:
    return sha256(b" ".join(folded[a:b].tobytes() for a, b in zip(starts[at : at + length].tolist(), ends[at : at + length].tolist()))).digest()


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            data, offsets = text_bytes(batch.column(1))
            starts, ends, hashes, first = words(data, offsets, ALNUM)
            folded = FOLD[data]
            ids, lengths, rolls, digests = [], [], [], []
            for row, item in enumerate(batch.column(0).to_pylist()):
                low, high = int(first[row]), int(first[row + 1])
                length = min(size, high - low)
                if not length:
                    continue
                rolls.append(rolled(hashes[low:high], length).view(np.int64))
                ids += [item] * len(rolls[-1])
                lengths += [length] * len(rolls[-1])
                digests += [_digest(folded, starts, ends, at, length) for at in range(low, high - length + 1)]
            roll = pa.array(np.concatenate(rolls) if rolls else np.zeros(0, np.int64))
            columns = [pa.array(ids, pa.string()), pa.array(lengths, pa.int32()), roll, pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "length", "roll", "digest"])

    return run


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """The distinct (item, length, roll, digest) of the benchmark's windows, written once."""
    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return materialize(items.mapInArrow(_windows(size), PAIR).distinct(), "windows")


def window_blocks(pairs: DataFrame, parts: int) -> list:
    """Broadcasts of {(length, roll, digest): [items]}, the pairs dealt to `parts` of them."""
    blocks = []
    for part in range(parts):
        found: dict[tuple[int, int, bytes], list[str]] = {}
        for row in pairs.where(F.pmod(F.xxhash64("item", "digest"), F.lit(parts)) == part).toLocalIterator():
            found.setdefault((row.length, row.roll, bytes(row.digest)), []).append(row["item"])
        blocks.append(pairs.sparkSession.sparkContext.broadcast(found))
    return blocks


class Windows:
    """One block of windows, ready for scanning: per window length a sorted
    array of hashes and a bit table that most positions fail."""

    def __init__(self, found: dict[tuple[int, int, bytes], list[str]]) -> None:
        self.items = {(length, digest): items for (length, _, digest), items in found.items()}
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({key[0] for key in found}):
            keys = np.unique(np.array([roll for own, roll, _ in found if own == length], np.int64).view(np.uint64))
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[keys & np.uint64((1 << _BITS) - 1)] = True
            self.by_length[length] = keys, bits

    def hits(self, folded: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, list[str]]]:
        """(row, first word, last word, items) of every verified window, unordered."""
        for length, (keys, bits) in self.by_length.items():
            runs = rolled(hashes, length)
            maybe = np.flatnonzero(bits[runs & np.uint64((1 << _BITS) - 1)])
            maybe = maybe[np.isin(runs[maybe], keys)]
            for row, at in zip(*_inside(first, maybe, length)):
                items = self.items.get((length, _digest(folded, starts, ends, at, length)))
                if items is not None:
                    yield row, at, at + length - 1, items


def _inside(first: np.ndarray, at: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """(row, first word) of the windows at the words `at` that lie in one row."""
    row = np.searchsorted(first, at, "right") - 1
    within = at + length <= first[row + 1]
    return row[within].tolist(), at[within].tolist()


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edges == 1).tolist(), (np.flatnonzero(edges == -1) - 1).tolist()))


def _spans(flags: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[dict[str, int]]:
    """The runs of a row's flagged words. `starts` and `ends` are bytes of its `text`."""
    before = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])  # code points before each byte
    return [{"first": a, "last": b, "start": int(before[starts[a]]), "end": int(before[ends[b]])} for a, b in _runs(flags)]


def _scan(block, text_at: int, result_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(block.value)
        for batch in sliced(batches, text_at):
            data, offsets = text_bytes(batch.column(text_at))
            starts, ends, hashes, first = words(data, offsets, ALNUM)
            hit: dict[int, tuple[np.ndarray, set[str]]] = {}
            for row, at, last, items in windows.hits(FOLD[data], starts, ends, hashes, first):
                if row not in hit:
                    hit[row] = np.zeros(first[row + 1] - first[row], dtype=bool), set()
                hit[row][0][at - first[row] : last - first[row] + 1] = True
                hit[row][1].update(items)
            spans, found = batch.column(result_at + 1).to_pylist(), batch.column(result_at + 2).to_pylist()
            for row, (flags, items) in hit.items():
                for span in spans[row]:
                    flags[span["first"] : span["last"] + 1] = True
                low, own = int(offsets[row]), slice(first[row], first[row + 1])
                spans[row] = _spans(flags, data[low : offsets[row + 1]], starts[own] - low, ends[own] - low)
                found[row] = sorted(items.union(found[row]))
            columns = list(batch.columns)
            columns[result_at : result_at + 3] = [pa.array(np.diff(first), pa.int64()), pa.array(spans, pa.list_(SPAN)), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _candidates(table, lengths: list[int]):
    """(row, at, length, roll, digest) of the windows that pass the bit table; `at` counts words in the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            data, offsets = text_bytes(batch.column(1))
            starts, ends, hashes, first = words(data, offsets, ALNUM)
            ids, folded = batch.column(0).to_pylist(), FOLD[data]
            for length in lengths:
                runs = rolled(hashes, length).view(np.int64)
                maybe = np.flatnonzero(passing(table.value, pa.array(runs)).to_numpy(zero_copy_only=False))
                rows, at = _inside(first, maybe, length)
                columns = [
                    pa.array([ids[row] for row in rows], pa.int64()),
                    pa.array([a - int(first[row]) for row, a in zip(rows, at)], pa.int32()),
                    pa.array([length] * len(at), pa.int32()),
                    pa.array(runs[at] if at else [], pa.int64()),
                    pa.array([_digest(folded, starts, ends, a, length) for a in at], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", "at", "length", "roll", "digest"])

    return run


def _marked(text_at: int, result_at: int):
    """Turns the hit windows in the spans' place (first and last word) into runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_at):
            data, offsets = text_bytes(batch.column(text_at))
            starts, ends, _, first = words(data, offsets, ALNUM)
            spans = batch.column(result_at + 1).to_pylist()
            for row, windows in enumerate(spans):
                if windows:
                    flags = np.zeros(first[row + 1] - first[row], dtype=bool)
                    for window in windows:
                        flags[window["first"] : window["last"] + 1] = True
                    low, own = int(offsets[row]), slice(first[row], first[row + 1])
                    spans[row] = _spans(flags, data[low : offsets[row + 1]], starts[own] - low, ends[own] - low)
            columns = list(batch.columns)
            columns[result_at : result_at + 2] = [pa.array(np.diff(first), pa.int64()), pa.array(spans, pa.list_(SPAN))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _joined(docs: DataFrame, pairs: DataFrame, text_col: str) -> DataFrame:
    """`docs` with the hits of all `pairs`, which are shuffled and not broadcast."""
    window = ["length", "roll", "digest"]
    rows = materialize(docs.withColumn("__bench_row", F.monotonically_increasing_id()), "rows")
    distinct = pairs.select(*window).distinct()
    lengths = [row.length for row in pairs.select("length").distinct().collect()]  # at most the window's words
    table = bit_table(distinct.select("roll"), "roll", hashed=True)
    maybe = rows.select("__bench_row", F.col(f"`{text_col}`")).mapInArrow(_candidates(table, lengths), "row long, at int, length int, roll long, digest binary")
    hits = materialize(maybe.join(distinct, window), "hits")
    place = F.struct(F.col("at").alias("first"), (F.col("at") + F.col("length") - 1).alias("last"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    spans = hits.groupBy("row").agg(F.collect_list(place).alias("__bench_spans"))
    items = hits.select("row", *window).distinct().join(pairs, window).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("__bench_items"))
    found = spans.join(items, "row").withColumnRenamed("row", "__bench_row")
    out = rows.join(found, "__bench_row", "left").select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.lit(0).cast("long").alias("__bench_words"),
        F.coalesce("__bench_spans", F.array()).cast(RESULT).alias("__bench_spans"),
        F.coalesce("__bench_items", F.array()).cast("array<string>").alias("__bench_items"),
    )
    return map_rows(out, _marked(docs.columns.index(text_col), len(docs.columns)))


def contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, block: int = BLOCK, chain: int = CHAIN
) -> DataFrame:
    """`docs` with __bench_words (words of the text), __bench_spans (maximal runs
    of hit words: first and last word, start and end code point) and
    __bench_items (ids of the items with a window in the text, as sorted text)."""
    pairs = benchmark_windows(benchmark, item_id, item_text, size)
    count = pairs.count()
    parts = 1 if count <= block else -(-count // (block // 2))  # several are half full on average, so that each stays below its bound
    if parts > chain:
        return _joined(docs, pairs, text_col)
    out = docs.select(
        "*",
        F.lit(0).cast("long").alias("__bench_words"),
        F.array().cast(RESULT).alias("__bench_spans"),
        F.array().cast("array<string>").alias("__bench_items"),
    )
    for found in window_blocks(pairs, parts):
        out = map_rows(out, _scan(found, docs.columns.index(text_col), len(docs.columns)))
    return out


def hit_words() -> F.Column:
    """Words of the text that lie in an occurrence of a window."""
    spans = F.transform("__bench_spans", lambda s: (s["last"] - s["first"] + 1).cast("long"))
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, b: a + b)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents", **options) -> DataFrame:
    """`docs` without contaminated documents, or (`remove="spans"`) with every
    run of hit words cut from the text; rows without hits are unchanged."""
    found = contamination(docs, benchmark, text_col, **options)
    if remove == "documents":
        return found.where(F.size("__bench_spans") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
    cuts = F.aggregate(
        "__bench_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("kept")),
        lambda s, x: F.struct(x["end"].alias("at"), F.concat(s["kept"], F.col(text_col).substr(s["at"] + 1, x["start"] - s["at"])).alias("kept")),
        lambda s: F.concat(s["kept"], F.col(text_col).substr(s["at"] + 1, F.length(text_col))),
    )
    text = F.when(F.size("__bench_spans") > 0, cuts).otherwise(F.col(text_col))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
