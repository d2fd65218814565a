"""Connected components of a link table by distributed union-find.

Links are first contracted inside each partition (a union-find over that
partition's links), and what is left of them once more in partitions of up to
`TASK_LINKS` links. Links that fill one such partition are then done; beyond
that, alternating large-star and small-star rounds hang every node below the
smallest of its component. Each round is a groupBy-min and a join, so a node
with a third of all links is pre-aggregated and its join can be split. Only
counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize

#: Links that one task contracts: a union-find of some 30 MB.
TASK_LINKS = 100_000


class Forest:
    """Union-find over hashable, ordered nodes; a root is its tree's smallest node."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x] = root
            x = up
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def links(self) -> tuple[list, list]:
        nodes = [x for x in self.parent if self.find(x) != x]
        return nodes, [self.find(x) for x in nodes]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, schema = Forest(), None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.union(a, b)
    if schema is not None:
        nodes, roots = forest.links()
        yield pa.RecordBatch.from_arrays([pa.array(nodes, schema.field(0).type), pa.array(roots, schema.field(1).type)], ["u", "v"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written first, so that both sides of the join are plain shuffles and a hot node's links can be split.
    low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "low")
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    low = materialize(links.groupBy("u").agg(F.min("v").alias("m")), "low")
    moved = links.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that is linked to a smaller one: `root` is
    the smallest node of its component. Roots themselves have no row.

    Nodes may be of any ordered type. Null ends, self-links and repeated links
    are ignored; no links give an empty result.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = materialize(links.mapInArrow(_contracted, links.schema), "links")
    tasks = -(-links.count() // TASK_LINKS)
    if tasks < links.rdd.getNumPartitions():
        done, links = links, materialize(links.coalesce(max(1, tasks)).mapInArrow(_contracted, links.schema), "links")
        discard(done)
    if tasks <= 1:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    while True:
        # Links point from a larger to a smaller node from here on.
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        done, links = links, materialize(_small_star(materialize(_large_star(links), "links")), "links")
        discard(done)
