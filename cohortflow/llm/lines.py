r"""Fuzzy line deduplication by MinHash over character shingles.

A text is cut at "\n"; a line is compared lower-cased and trimmed. Equal lines
are one node (the MD5 of the compared line). Each node's shingles of `CHARS`
characters (the line is padded at its end, so short lines have some too) get
`BANDS` x `ROWS` min-hashes; lines that agree on a whole band are candidates.
At similarity 0.8 a pair is missed by every band with probability 3e-5.
Candidates meet in one task per band bucket as text and are verified exactly on
their whole shingle sets; a bucket of too many lines is divided by further
min-hashes first, and the lines of all such buckets then go through an exact
prefix join, so a pair that meets in one is never missed. Components come from distributed union-find, and each keeps
its first line, by id and line number.

Defined results: null and empty texts have no lines; blank lines are never
duplicates and are always kept; rows that share an id share their lines' fate
by text, and the earliest of equal (id, line) places is kept in each of them;
null ids sort first; extra columns are ignored, and passed through by
`deduplicated` under any name that does not start with `__line_`; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize
from . import sets as S
from .components import components
from .membership import bit_table, passing
from .minhash_forest import forest_links
from .text import distinct, map_rows, rolled, sliced

CHARS, BANDS, ROWS, PERCENT = 8, 20, 4, 80
#: Characters that are sketched in one step.
STEP = 1 << 16
#: Nodes that a task remembers, to sketch each once.
SEEN = 100_000


def cut_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, list[bytes | None]]:
    """(row, line number, trimmed line, node) of the lines of lower-cased texts;
    the node is None for a blank line. A null or empty text has none."""
    at = np.flatnonzero(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    split = pc.split_pattern(column.take(pa.array(at)), "\n")
    count = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    lines = pc.utf8_trim(split.flatten(), " ")
    nodes = [md5(line, usedforsecurity=False).digest() if line else None for line in lines.cast(pa.binary()).to_pylist()]
    return np.repeat(at, count), number.astype(np.int32), lines, nodes


def shingle_runs(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, begin, end) for consecutive parts of the rows: row i of the part
    has the shingle hashes[begin[i]:end[i]]. Rows are not empty."""
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.searchsorted(np.cumsum(lengths), np.arange(STEP, int(lengths.sum()) + STEP, STEP), "right")
    low = 0
    for high in np.unique(np.append(cuts + 1, len(lengths))).tolist():
        high = min(high, len(lengths))
        if high <= low:
            continue
        own = lengths[low:high]
        codes = np.frombuffer("".join(column.slice(low, high - low).to_pylist()).encode("utf-32-le"), np.uint32)
        pad = size - 1
        begin = np.concatenate([[0], np.cumsum(own + pad)[:-1]])
        padded = np.zeros(int((own + pad).sum()), dtype=np.uint64)
        padded[np.arange(len(codes)) + np.repeat(np.arange(len(own)) * pad, own)] = codes.astype(np.uint64) + np.uint64(1)
        yield rolled(padded, size), begin, begin + own
        low = high


def band_keys(lines: pa.Array, size: int, bands: int, rows: int) -> np.ndarray:
    """The band keys of each line, as lines x bands."""
    a, b = S.permutations(bands * rows)
    parts = [np.zeros((0, bands * rows), np.uint32)]
    for hashes, begin, end in shingle_runs(lines, size):
        short = np.append((hashes >> np.uint64(32)).astype(np.uint32), np.uint32(0xFFFFFFFF))
        edges = np.stack([begin, end], axis=1).ravel()
        part, own = np.empty((bands * rows, len(begin)), np.uint32), np.empty_like(short)
        for p in range(bands * rows):
            np.multiply(short, a[p], out=own)
            own += b[p]
            part[p] = np.minimum.reduceat(own, edges)[::2]
        parts.append(part.T)
    low = np.concatenate(parts)
    return np.stack([S.combined(low[:, t * rows : (t + 1) * rows], t + 1) for t in range(bands)], axis=1)


class _Seen:
    """Tells the first rows of each node that a task meets, as far as it remembers."""

    def __init__(self) -> None:
        self.nodes: set[bytes] = set()

    def new(self, nodes: list[bytes | None]) -> np.ndarray:
        if len(self.nodes) > SEEN:
            self.nodes.clear()
        first = []
        for at, node in enumerate(nodes):
            if node is not None and node not in self.nodes:
                self.nodes.add(node)
                first.append(at)
        return np.array(first, dtype=np.int64)


def _sketched(size: int, bands: int, rows: int):
    """(id, line_no, node, keys) of all lines; a line that the task has met before has no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in sliced(batches, 1):
            row, number, lines, nodes = cut_lines(batch.column(1))
            first = seen.new(nodes)
            keys = band_keys(lines.take(pa.array(first)), size, bands, rows)
            place = np.full(len(nodes), len(first))
            place[first] = np.arange(len(first))
            packed = S.packed(keys).take(pa.array(place, mask=place == len(first)))
            columns = [batch.column(0).take(pa.array(row)), pa.array(number), pa.array(nodes, pa.binary()), packed]
            yield pa.RecordBatch.from_arrays(columns, ["id", "line_no", "node", "keys"])

    return run


def _kept(table):
    """(node, set): the lines of the nodes in the table, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in sliced(batches, 0):
            _, _, lines, nodes = cut_lines(batch.column(0))
            filled = np.array([at for at, node in enumerate(nodes) if node is not None], dtype=np.int64)
            hashes = np.frombuffer(b"".join(nodes[at] for at in filled.tolist()), ">i8")[::2]
            filled = filled[passing(table.value, pa.array(hashes.astype(np.int64))).to_numpy(zero_copy_only=False)]
            found = [nodes[at] for at in filled.tolist()]
            first = seen.new(found)
            columns = [pa.array([found[at] for at in first.tolist()], pa.binary()), lines.take(pa.array(filled[first])).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "set"])

    return run


class LineSets:
    """The shingle sets of lines that travel as text: an eighth of the size of their hashes."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        for hashes, begin, end in shingle_runs(column.cast(pa.string()), self.size):
            for a, b in zip(begin.tolist(), end.tolist()):
                yield distinct(hashes[a:b])


def near_duplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, chars: int = CHARS, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT
) -> DataFrame:
    """One row per line: id_col, line_no, component (a key that near-duplicate
    lines share; null for a blank line), first_id and first_line (the
    component's first place) and kept."""
    kind = docs.schema[id_col].dataType.simpleString()
    folded = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"))
    lines = folded.mapInArrow(_sketched(chars, bands, rows), f"id {kind}, line_no int, node binary, keys binary")
    lines = materialize(lines, "sketch")
    places = materialize(lines.select("id", "line_no", "node"), "places")

    def sets_of(nodes: DataFrame) -> DataFrame:
        discard(lines)  # the nodes come from the regions, which are written: nothing reads the keys any more
        start = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")  # MD5 is a hash already
        table = bit_table(nodes.select(start.alias("h")), "h", hashed=True)
        return folded.select("text").mapInArrow(_kept(table), "node binary, set binary").dropDuplicates(["node"])

    sketch = lines.where("keys is not null").select("node", "keys")
    roots = components(forest_links(sketch, sets_of, percent, LineSets(chars)), "a", "b")
    named = places.join(roots, "node", "left").select("id", "line_no", F.coalesce("root", "node").alias("component"))
    named = materialize(named, "lines")
    firsts = named.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min(F.struct("id", "line_no")).alias("first"))
    out = named.join(firsts, F.col("component") == F.col("c"), "left")
    here = F.struct("id", "line_no").eqNullSafe(F.col("first"))
    return out.select(
        F.col("id").cast(kind).alias(id_col),
        F.col("line_no").cast("long").alias("line_no"),
        F.lower(F.hex("component")).alias("component"),
        F.col("first.id").alias("first_id"),
        F.col("first.line_no").cast("long").alias("first_line"),
        (F.col("component").isNull() | here).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with every line cut from its text that is not the first of its component."""
    cut = near_duplicate_lines(docs, id_col, text_col, **options).where(~F.col("kept"))
    cut = cut.groupBy(F.col(id_col).alias("__line_id")).agg(F.collect_set(F.col("line_no").cast("int")).alias("__line_cut"))
    out = docs.join(cut, F.col(id_col).eqNullSafe(F.col("__line_id")), "left")
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], "__line_cut")
    return map_rows(out, _without_lines(docs.columns.index(text_col)), docs.schema)


def _without_lines(text_at: int):
    """Cuts the lines whose numbers the last column lists, and the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_at):
            columns, cuts = list(batch.columns[:-1]), batch.column(batch.num_columns - 1).to_pylist()
            texts = columns[text_at].to_pylist()
            for row, numbers in enumerate(cuts):
                if numbers:
                    gone = set(numbers)
                    texts[row] = "\n".join(line for i, line in enumerate(texts[row].split("\n")) if i not in gone)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return run
