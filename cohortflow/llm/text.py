"""Words, hashes and shingles of whole Arrow text columns, vectorised.

Texts are read as UTF-8 bytes, straight from the Arrow buffers. A word is a
maximal run of bytes that a 256-entry table keeps; bytes from 0x80 up are
always kept, so a run of bytes is a run of characters. A-Z is folded to a-z.
Work goes in pieces of a few MB that end at a non-word byte, so memory does
not follow the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

PIECE = 1 << 20
SLICE = 2 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def _table(dropped: list[int]) -> np.ndarray:
    keep = np.ones(256, dtype=bool)
    keep[dropped] = False
    return keep


#: Words `[^\x20\x09-\x0D]+`.
SPACED = _table([0x20, *range(0x09, 0x0E)])
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of the folded text: letters, digits and all beyond ASCII.
ALNUM = _table([b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its row offsets in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return to the system what earlier steps of this worker have freed.

    Workers serve many tasks, and the allocators keep freed memory for the
    next; stages of different needs would otherwise add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def sliced(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `SLICE` bytes of text (column `at`), so that
    the arrays of a worker's step follow neither the batch size nor the mean
    text; a longer text is a slice of its own."""
    give_back()
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    give_back()


def map_rows(rows: DataFrame, run, schema: StructType | None = None) -> DataFrame:
    """`rows.mapInArrow(run)`, for rows with columns of any names, dots included.
    `run` sees plain names and finds columns by their place."""
    schema = schema or rows.schema
    out = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(run, out).toDF(*schema.names)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two multiply-xorshift rounds); changes and returns `x`."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STEP = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> np.ndarray:
    """1, s, s^2, ... modulo 2^64 for an odd s."""
    out = np.full(max(n, 1), _STEP, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _pieces(data: np.ndarray, keep: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data):
            stops = np.flatnonzero(~keep[data[end : end + 4096]])
            if len(stops):
                end += int(stops[0])
                break
            end = min(len(data), end + 4096)
        yield at, end
        at = end


def words(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first): words of all rows in order. Row i has the
    words first[i] to first[i + 1]; a word never crosses a row's end."""
    all_starts, all_ends, all_hashes = [], [], []
    inner = offsets[1:-1]
    for at, end in _pieces(data, keep):
        part = data[at:end]
        flags = np.zeros(len(part) + 2, dtype=np.int8)
        mask = keep[part]
        flags[1:-1] = mask
        edges = np.diff(flags)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        cuts = inner[np.searchsorted(inner, at, "right") : np.searchsorted(inner, end)] - at
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(part))])
        cuts = cuts[mask[cuts - 1] & mask[cuts]]
        if len(cuts):
            starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        if not len(starts):
            continue
        length = ends - starts
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(begin, length)
        value = (FOLD[part[mask]].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[place]
        hashes = mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _STEP)
        all_starts.append(starts + at)
        all_ends.append(ends + at)
        all_hashes.append(hashes)
    empty = np.zeros(0, np.int64)
    starts = np.concatenate(all_starts) if all_starts else empty
    ends = np.concatenate(all_ends) if all_ends else empty
    hashes = np.concatenate(all_hashes) if all_hashes else np.zeros(0, np.uint64)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` consecutive word hashes."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    factor = powers(size + 1)
    # The sum of hashes[i + j] * factor[j + 1] over j, from the sums over 1, 2, 4, ... of them.
    span, done, out, part = 1, 0, None, hashes * factor[1]
    while True:
        if size & span:
            own = part[done : done + len(hashes) - size + 1]
            out = own * factor[done] if out is None else out + own * factor[done]
            done += span
        if done == size:
            return mix(out + np.uint64(size))
        part = part[: len(part) - span] + part[span:] * factor[span]
        span *= 2


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The sorted distinct hashes; quicker on short arrays than `np.unique`."""
    out = np.sort(hashes)
    new = np.ones(len(out), dtype=bool)
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Each row's distinct shingles of `size` words, sorted; a row of fewer
    words, but not none, has its whole sequence as its one shingle."""
    runs = rolled(hashes, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield distinct(runs[a : b - size + 1])
        elif b > a:
            yield rolled(hashes[a:b], b - a)
        else:
            yield hashes[:0]


def text_shingles(column: pa.Array, size: int, keep: np.ndarray = SPACED) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(column)
    _, _, hashes, first = words(data, offsets, keep)
    return shingle_sets(hashes, first, size)
