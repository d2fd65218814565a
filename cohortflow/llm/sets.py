"""Exact links between sets that share a region, found inside bounded regions.

A region is a bucket of candidate rows (rows that agree on some min-hashes).
Members of one region meet in one task with their whole sets. Every pair of
the region is compared exactly and the task returns a spanning forest of the
links, so neither the pairs nor the links of a group of copies are written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .components import components
from .text import mix

#: One of so many regions is compared first.
EARLY = 4
#: Cells of the 0/1 matrix that one comparison step holds.
CELLS = 1 << 22
#: Bytes of a packed key.
KEY = 5


#: Gives the sorted distinct elements of each row of a "set" column, one row at a time.
Unpack = Callable[[pa.Array], Iterator[np.ndarray]]


def unpack(column: pa.Array) -> Iterator[np.ndarray]:
    """Sets that are stored as packed 64-bit elements."""
    return (np.frombuffer(blob.as_buffer(), dtype=np.uint64) for blob in column)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays."""
    n = len(sets)
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    item = np.cumsum(new) - 1
    shared = np.bincount(item)[item] > 1  # only elements that two sets hold can count
    owners, item = owners[shared], item[shared]
    out = np.diag([float(len(s)) for s in sets])
    off = np.zeros((n, n), dtype=np.float32)
    if len(item):
        item = np.cumsum(np.concatenate([[0], np.diff(item) != 0]))
        count = int(item[-1]) + 1
        step = max(1, CELLS // n)
        for low in range(0, count, step):
            a, b = np.searchsorted(item, [low, low + step])
            cells = np.zeros((n, min(step, count - low)), dtype=np.float32)
            cells[owners[a:b], item[a:b] - low] = 1
            off += cells @ cells.T
    np.fill_diagonal(off, 0)
    return out + off


def region_links(ids: list, sets: list[np.ndarray], percent: int) -> Iterator[tuple]:
    """A spanning forest of the region's links: 100 * shared >= percent * union."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    if len(sets) == 2:
        if 100 * sizes.min() < percent * sizes.max():
            return
        both = np.sort(np.concatenate(sets))
        shared = float(np.count_nonzero(both[1:] == both[:-1]))
        if 100 * shared >= percent * (sizes.sum() - shared):
            yield ids[0], ids[1]
        return
    shared = intersections(sets)
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    apart = np.ones(len(ids), dtype=bool)
    for start in range(len(ids)):
        if not apart[start]:
            continue
        apart[start] = False
        reached = [start]
        for a in reached:
            found = np.flatnonzero(linked[a] & apart)
            apart[found] = False
            for b in found.tolist():
                reached.append(b)
                yield ids[a], ids[b]


def _verified(percent: int, unpack: Unpack):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, ids, sets, kind = None, [], [], None
        links: list[tuple] = []

        def close() -> None:
            if len(ids) > 1:
                links.extend(region_links(ids, sets, percent))

        def out() -> pa.RecordBatch:
            a, b = (list(x) for x in zip(*links)) if links else ([], [])
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

        for batch in batches:
            kind = batch.schema.field("node").type
            for key, node, items in zip(batch.column("region").to_pylist(), batch.column("node").to_pylist(), unpack(batch.column("set"))):
                if key != region:
                    close()
                    region, ids, sets = key, [], []
                ids.append(node)
                sets.append(items)
            if len(links) > 50_000:
                yield out()
        close()
        if links:
            yield out()

    return run


def region_join(members: DataFrame, sets: DataFrame, percent: int, unpack: Unpack = unpack) -> DataFrame:
    """Links (a, b) between members of one region.

    `members` (region, node) has regions of a bounded number of rows; `sets`
    (node, set) has what `unpack` turns into each node's elements.
    """
    node = members.schema["node"].dataType.simpleString()
    return (
        members.join(sets, "node")
        .select("region", "node", "set")
        .repartition("region")
        .sortWithinPartitions("region", "node")
        .mapInArrow(_verified(percent, unpack), f"a {node}, b {node}")
    )


def linked(members: DataFrame, sets: DataFrame, percent: int, unpack: Unpack = unpack) -> DataFrame:
    """Links (a, b) that connect what the links of all regions connect.

    A share of the regions is compared first. Of the others only those are
    compared whose members the links found so far leave in several components:
    a link inside a component changes nothing.
    """
    members = materialize(members, "members")
    early = F.pmod(F.xxhash64("region"), F.lit(EARLY)) == 0
    roots = components(region_join(members.where(early), sets, percent, unpack), "a", "b")
    named = members.where(~early).join(roots, "node", "left").select("region", "node", F.coalesce("root", "node").alias("part"))
    open_regions = named.groupBy("region").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    rest = named.join(open_regions.select("region"), "region").select("region", "node")
    return region_join(rest, sets, percent, unpack).unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))


def _deeper(levels: int, hashes: int, unpack: Unpack):
    """Region keys of `levels` more levels: each adds `hashes` min-hashes under
    permutations that all rows of the region share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((batch.num_rows, levels), dtype=np.int64)
            for row, (key, items) in enumerate(zip(batch.column("region").to_pylist(), unpack(batch.column("set")))):
                seed = np.uint64(key & 0xFFFFFFFFFFFFFFFF)
                low = signature(items, *permutations(levels * hashes, seed))[None, :]
                for level in range(levels):
                    seed = combined(low[:, level * hashes : (level + 1) * hashes], seed).view(np.uint64)[0]
                    keys[row, level] = seed.view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, levels, dtype=np.int32), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([lists, batch.column("node")], ["keys", "node"])

    return run


def permutations(n: int, seed: int | np.uint64 = 0) -> tuple[np.ndarray, np.ndarray]:
    """n multiply-add permutations of 32-bit values: (factors, terms)."""
    seeds = mix(np.uint64(seed) + np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (seeds[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> np.uint64(32)).astype(np.uint32)


def signature(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each permutation over the set's elements."""
    low = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    short = (items >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        x = short[at : at + 512, None] * a
        x += b
        np.minimum(low, x.min(axis=0), out=low)
    return low


def combined(hashes: np.ndarray, salt) -> np.ndarray:
    """One signed 64-bit key per row of a matrix of min-hashes."""
    key = np.full(len(hashes), salt, dtype=np.uint64)
    for column in hashes.astype(np.uint64).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1))
    return key.view(np.int64)


def packed(keys: np.ndarray) -> pa.Array:
    """Each row of a matrix of 64-bit keys as one binary value, `KEY` bytes of
    each key. Keys of two columns stay apart, and those of one column that are
    taken for equal by chance only cost a comparison."""
    own = np.ascontiguousarray(keys.astype("<i8").view(np.uint8).reshape(*keys.shape, 8)[:, :, :KEY])
    offsets = np.arange(len(keys) + 1, dtype=np.int32) * np.int32(KEY * keys.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(own)])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number of keys of each row) of a column that `packed` made, or of lists."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.diff(column.offsets.to_numpy())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    own = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    count = np.diff(offsets) // KEY
    wide = np.zeros((len(own) // KEY, 8), np.uint8)
    wide[:, :KEY] = own.reshape(-1, KEY)
    place = np.arange(len(wide)) - np.repeat(np.cumsum(count) - count, count)
    return wide.view("<u8").ravel().astype(np.uint64) | place.astype(np.uint64) << np.uint64(8 * KEY), count


def region_sizes(rows: DataFrame) -> DataFrame:
    """Regions of two rows or more: (region, n, digest of the members)."""
    return (
        rows.groupBy("region")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("digest"))
        .where("n > 1")
    )


def bounded_regions(rows: DataFrame, sizes: DataFrame, limit: int) -> DataFrame:
    """Members (region, node) of the regions of at most `limit` rows; of
    several regions with the same members (copies of one group found again by
    another order) one stays."""
    once = sizes.where(F.col("n") <= limit).groupBy("n", "digest").agg(F.min("region").alias("region"))
    return rows.join(once.select("region"), "region").select("region", "node")


def refined(rows: DataFrame, sets: DataFrame, levels: int, hashes: int, unpack: Unpack = unpack) -> DataFrame:
    """(keys, node): for each row of a too large region its region keys on the
    next `levels` levels."""
    node = rows.schema["node"].dataType.simpleString()
    joined = rows.join(sets, "node").select("region", "node", "set")
    return joined.mapInArrow(_deeper(levels, hashes, unpack), f"keys array<long>, node {node}")


def blocked(rows: DataFrame, sizes: DataFrame, limit: int) -> DataFrame:
    """Regions that no depth divides, in blocks of about half of `limit` rows
    that all hold the region's smallest node."""
    pivot = rows.groupBy("region").agg(F.min("node").alias("pivot"))
    parts = sizes.select("region", F.ceil(F.col("n") * 2 / F.lit(limit)).alias("parts")).join(pivot, "region")
    dealt = rows.join(parts, "region")
    block = F.xxhash64("region", F.pmod(F.xxhash64("node"), "parts"))
    own = dealt.where("node <> pivot").select(block.alias("region"), "node")
    shared = parts.select(F.col("region").alias("r"), "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("p"))
    return own.unionByName(shared.select(F.xxhash64("r", "p").alias("region"), F.col("pivot").alias("node")))
