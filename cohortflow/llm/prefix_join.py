"""All links between the sets of crowded regions, by an exact distributed prefix join.

Elements have one global order, rarest first. Two sets with at least the wanted
Jaccard share an element of both their prefixes (`1 - percent` of a set), and
their first shared element stands so early in both that what is left can still
reach the wanted similarity. So the pairs that share a prefix element and pass
the size and position bounds are all there can be; they are verified on their
full sets. Nothing is left to chance: the order only decides how many pairs
must be looked at.

Only links between different parts (components known so far) are looked for,
so an element whose holders are all in one part costs nothing. The holders of
a hot element are dealt into blocks; every pair of blocks that can hold rows
of two parts meets in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from . import sets as S
from .components import components
from .membership import bit_table, passing
from .text import mix

#: Buckets of the table of element counts: 4 MB. More elements only make the order less sharp.
BUCKETS = 1 << 20
#: Holders of one element in one block.
BLOCK = 512


def _bucket(items: np.ndarray) -> np.ndarray:
    return (mix(items.copy()) % np.uint64(BUCKETS)).astype(np.int64)


def _tallied(unpack: S.Unpack):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for items in unpack(batch.column("set")):
                np.add.at(total, _bucket(items), 1)
        found = np.flatnonzero(total)
        for at in range(0, len(found), 1 << 16):
            part = found[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["bucket", "n"])

    return run


def element_counts(sets: DataFrame, unpack: S.Unpack = S.unpack) -> np.ndarray:
    """For each bucket of elements an upper bound of the sets that hold one of them."""
    rows = sets.select("set").mapInArrow(_tallied(unpack), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(BUCKETS, dtype=np.uint32)
    table[rows.bucket.to_numpy(dtype=np.int64)] = np.minimum(rows.n.to_numpy(dtype=np.int64), 0xFFFFFFFF)
    return table


def prefix(items: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, positions) of the set's prefix that another set may hold too."""
    n = counts[_bucket(items)]
    order = np.lexsort((items, n))[: len(items) - -(-percent * len(items) // 100) + 1]
    at = np.flatnonzero(n[order] > 1)
    return items[order[at]], at


def _posted(counts, percent: int, unpack: S.Unpack):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            for items in unpack(batch.column("set")):
                sizes.append(len(items))
                found.append(prefix(items, counts.value, percent))
            row = np.repeat(np.arange(len(sizes)), [len(f[0]) for f in found[1:]])
            take = pa.array(row)
            columns = [
                pa.array(np.concatenate([f[0] for f in found]).view(np.int64)),
                batch.column("node").take(take),
                batch.column("part").take(take),
                pa.array(np.array(sizes, np.int32)[row]),
                pa.array(np.concatenate([f[1] for f in found]).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["element", "node", "part", "n", "at"])

    return run


def _open(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(passing(table.value, batch.column("h"))).select(["element", "node", "part", "n", "at"])

    return run


def _paired(percent: int):
    """Pairs (a, b, low, high) of each cell that pass the bounds; low and high are their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(rows: pa.Table) -> pa.RecordBatch:
            cell, n, at = (rows.column(c).to_numpy().astype(np.int64) for c in ("cell", "n", "at"))
            part = rows.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for low, high in zip(edges[:-1], edges[1:]):
                p = part[low:high]
                if (p == p[0]).all():
                    continue
                size, place = n[low:high], at[low:high]
                shared = np.minimum((size - place)[:, None], (size - place)[None, :])
                union = size[:, None] + place[None, :]
                may = (100 * shared >= percent * np.maximum(union, union.T)) & (p[:, None] != p[None, :])
                a, b = np.nonzero(np.triu(may, 1))
                left.append(a + low)
                right.append(b + low)
            a, b = pa.array(np.concatenate(left)), pa.array(np.concatenate(right))
            columns = [rows.column(c).combine_chunks().take(x) for c in ("node", "part") for x in (a, b)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "low", "high"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            cell = rows.column("cell").to_numpy()
            cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if cell[0] != cell[-1] else 0
            if cut:
                yield pairs(rows.slice(0, cut))
            rest = rows.slice(cut)
        if rest is not None:
            yield pairs(rest)

    return run


def cells(postings: DataFrame, opened: DataFrame, block: int) -> DataFrame:
    """(cell, node, part, n, at): rows of an element that must meet. Rows of the
    element's largest part meet the other rows only, not each other."""
    rows = postings.join(opened, "element")
    minor, own = F.col("part") != F.col("major"), F.xxhash64("node")
    rows = rows.withColumn("others", F.ceil(F.col("k") / block)).withColumn("majors", F.ceil((F.col("m") - F.col("k")) / block))
    to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    mine = F.when(minor, F.pmod(own, "others")).otherwise(F.pmod(own, "majors"))
    key = lambda i, j: F.xxhash64(F.col("element"), i, j)
    with_minor = F.transform(to(F.col("others")), lambda j: key(F.least(F.col("mine"), j), F.greatest(F.col("mine"), j)))
    with_major = F.transform(to(F.col("majors")), lambda j: key(F.col("mine"), -1 - j))
    from_major = F.transform(to(F.col("others")), lambda i: key(i, -1 - F.col("mine")))
    several = F.when(minor, F.concat(with_minor, with_major)).otherwise(from_major)
    found = F.when(F.col("m") <= block, F.array(F.xxhash64("element"))).otherwise(several)
    return rows.withColumn("mine", mine).select(F.explode(found).alias("cell"), "node", "part", "n", "at")


def candidates(crowd: DataFrame, percent: int, block: int = BLOCK, unpack: S.Unpack = S.unpack) -> DataFrame:
    """(a, b, low, high): all pairs of `crowd` (node, part, set) of two parts
    that may be linked, a < b, with their parts, low < high."""
    node = crowd.schema["node"].dataType.simpleString()
    counts = crowd.sparkSession.sparkContext.broadcast(element_counts(crowd, unpack))
    row = f"element long, node {node}, part {node}, n int, at int"
    postings = materialize(crowd.select("node", "part", "set").mapInArrow(_posted(counts, percent, unpack), row), "postings")
    parts = postings.groupBy("element", "part").agg(F.count(F.lit(1)).alias("n"))
    held = parts.groupBy("element").agg(F.sum("n").alias("m"), F.max(F.struct("n", "part")).alias("top"), F.count(F.lit(1)).alias("parts"))
    opened = held.where("parts > 1").select("element", "m", (F.col("m") - F.col("top.n")).alias("k"), F.col("top.part").alias("major"))
    opened = materialize(opened, "opened")
    kept = postings.withColumn("h", F.xxhash64("element")).mapInArrow(_open(bit_table(opened, "element")), row)
    met = cells(kept, opened, block).repartition("cell").sortWithinPartitions("cell")
    found = met.mapInArrow(_paired(percent), f"a {node}, b {node}, low {node}, high {node}")
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")]
    return found.select(*ordered).distinct()


def _verified(pairs: DataFrame, crowd: DataFrame, percent: int, unpack: S.Unpack) -> DataFrame:
    members = pairs.select(F.xxhash64("a", "b").alias("region"), F.explode(F.array("a", "b")).alias("node"))
    return S.region_join(members, crowd.select("node", "set"), percent, unpack)


def prefix_links(crowd: DataFrame, percent: int, block: int = BLOCK, unpack: S.Unpack = S.unpack) -> DataFrame:
    """Links (a, b) between rows of `crowd` (node, part, set) that connect what
    all links between its parts connect. One pair of each two parts is verified
    first, then all pairs of parts that are still apart."""
    pairs = materialize(candidates(crowd, percent, block, unpack), "candidates")
    one = pairs.groupBy("low", "high").agg(F.min(F.struct("a", "b")).alias("pair")).select("low", "high", "pair.a", "pair.b")
    first = materialize(_verified(one, crowd, percent, unpack), "links")
    joined = one.join(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), ["a", "b"])
    roots = components(joined.select("low", "high"), "low", "high")
    low = roots.select(F.col("node").alias("low"), F.col("root").alias("low_root"))
    high = roots.select(F.col("node").alias("high"), F.col("root").alias("high_root"))
    apart = pairs.join(low, "low", "left").join(high, "high", "left").where(F.coalesce("low_root", "low") != F.coalesce("high_root", "high"))
    apart = apart.join(one.select("a", "b"), ["a", "b"], "left_anti")
    return first.unionByName(_verified(apart.select("a", "b"), crowd, percent, unpack))
