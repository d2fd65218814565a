"""Near-duplicate documents by an LSH forest over word shingles.

Each document's set of word shingles gets `trees` short min-hash sequences.
In one tree, documents with a common prefix are neighbours and form a region.
All pairs of a region are compared on their full sets, and the links'
components are found by distributed union-find.

A region of more than `REGION` rows is divided by further min-hashes of its own
until it is small (or `LEVELS` is reached: then it is dealt into blocks that
share the region's smallest node). That only finds most links cheaply: the rows
of all such regions then go through an exact prefix join (`prefix_join`), which
finds every link between the components known so far.

* Texts with the same set are one node, so copies cost nothing beyond a groupBy.
* A pair at the least similarity s is missed by every order with probability
  (1 - s^depth)^trees: 8e-7 at 0.85 and 7e-5 at 0.8 for 24 trees of depth 5.
  A pair that meets in a crowded region is never missed.
* Regions that several trees find again are compared once.

Defined results: null and empty texts and texts without words have the empty
set and are linked with nothing; rows that share an id count as one document;
a row without id keeps its set size, has no component and is kept; columns of
other names are ignored, whatever they are called (`deduplicated` passes them
through; none may be `__id`); an empty table gives an empty result.
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
from .prefix_join import prefix_links
from .text import mix, sliced, text_shingles

TREES, DEPTH = 24, 5
#: Rows of a region that are compared with each other in one task.
REGION = 256
#: How often a too large region is divided by `DEEPER` more min-hashes.
LEVELS, DEEPER = 4, 4
#: Keys that a task packs at once, and parts of the packed keys for each shuffle partition.
DEALT, PARTS = 1 << 20, 4


def tree_keys(signatures: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Each row's region key in each tree, as rows x trees."""
    return np.stack([S.combined(signatures[:, t * depth : (t + 1) * depth], t + 1) for t in range(trees)], axis=1)


def _sketched(size: int, trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = S.permutations(trees * depth)
        for batch in sliced(batches, 1):
            n, one, two, signatures = [], [], [], []
            for items in text_shingles(batch.column(1), size):
                n.append(len(items))
                one.append(int(mix(items.copy()).sum(dtype=np.uint64).view(np.int64)) if len(items) else 0)
                two.append(int(mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)) if len(items) else 0)
                signatures.append(S.signature(items, a, b))
            keys = tree_keys(np.stack(signatures), trees, depth)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), S.packed(keys)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "one", "two", "keys"])

    return run


def _packed(size: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced((b.filter(passing(table.value, b.column(2))) for b in batches), 1):
            blobs = [items.tobytes() for items in text_shingles(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["node", "set"])

    return run


def _regions(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, 32 bits of the rest) of each key; both together are its region."""
    return keys % np.uint64(parts), keys // np.uint64(parts) & np.uint64(0xFFFFFFFF)


def _in_table(table, parts: int):
    """(region, node) of the keys whose regions pass the bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, count = S.unpacked(batch.column("keys"))
            part, rest = _regions(keys, parts)
            regions = pa.array((part << np.uint64(32) | rest).view(np.int64))
            row = pa.array(np.repeat(np.arange(batch.num_rows), count))
            mask = passing(table.value, regions)
            yield pa.RecordBatch.from_arrays([regions.filter(mask), batch.column("node").take(row.filter(mask))], ["region", "node"])

    return run


def _dealt(parts: int):
    """(part, rows): the rests of the keys of one part, each with 32 bits of its node's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            part, rows = (np.concatenate(x) for x in zip(*found))
            found.clear()
            order = np.argsort(part, kind="stable")
            part, rows = part[order], rows[order]
            own, cuts = np.unique(part, return_index=True)
            packed = [rows[a:b].tobytes() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)])]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(packed, pa.binary())], ["part", "rows"])

        for batch in batches:
            keys, count = S.unpacked(batch.column("keys"))
            part, rest = _regions(keys, parts)
            owner = batch.column("h").to_numpy(zero_copy_only=False).astype(np.uint64) & np.uint64(0xFFFFFFFF)
            found.append((part.astype(np.uint16 if parts < 1 << 16 else np.int32), rest << np.uint64(32) | np.repeat(owner, count)))
            if sum(len(rows) for _, rows in found) > DEALT:
                yield out()
        if found:
            yield out()

    return run


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The regions of two nodes or more, part by part."""
    part, found = None, []

    def out() -> pa.RecordBatch:
        rows = np.sort(np.concatenate(found))
        found.clear()
        rest = rows >> np.uint64(32)
        both = (rest[1:] == rest[:-1]) & (rows[1:] != rows[:-1])
        return pa.RecordBatch.from_arrays([pa.array((np.unique(rest[1:][both]) | np.uint64(part) << np.uint64(32)).view(np.int64))], ["region"])

    for batch in batches:
        for own, rows in zip(batch.column("part").to_pylist(), batch.column("rows")):
            if own != part and found:
                yield out()
            part = own
            found.append(np.frombuffer(rows.as_buffer(), np.uint64))
    if found:
        yield out()


def shared_regions(sketch: DataFrame) -> DataFrame:
    """(region, node), each once, for the keys of `sketch` (node, keys: packed
    or as array) that two nodes or more have; a node may have several rows.

    Keys are counted apart from their nodes, packed; most are nobody else's and
    are dropped in place by a bounded bit table of the others before anything
    with nodes is shuffled.
    """
    spark = sketch.sparkSession
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = sketch.select("keys", F.xxhash64("node").alias("h")).mapInArrow(_dealt(parts), "part int, rows binary")
    several = packed.repartition("part").sortWithinPartitions("part").mapInArrow(_several, "region long")
    several = materialize(several, "several")
    kind = sketch.schema["node"].dataType.simpleString()
    maybe = sketch.select("node", "keys").mapInArrow(_in_table(bit_table(several, "region", hashed=True), parts), f"region long, node {kind}")
    return materialize(maybe.join(several, "region").select("region", "node").distinct(), "shared")


def forest_regions(sketch: DataFrame, sets_of, limit: int = REGION, *, unpack: S.Unpack = S.unpack) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bounded regions (region, node) of `sketch` (node, keys: its packed regions,
    one in each order), the sets of their nodes, and the nodes of the regions over `limit`. `sets_of(nodes)` gives (node, set) for a table of nodes, each
    once; it may give others too."""
    rows = shared_regions(sketch)
    sizes = materialize(S.region_sizes(rows), "regions")
    members = [materialize(S.bounded_regions(rows, sizes, limit), "members")]
    large = sizes.where(F.col("n") > limit).select("region", "n")
    rows = materialize(rows.join(large.select("region"), "region").select("region", "node"), "crowded")
    crowded = rows.select("node").distinct()
    nodes = members[0].select("node").unionByName(rows.select("node")).distinct()
    sets = materialize(sets_of(nodes), "sets")
    if not rows.isEmpty():
        deep = materialize(S.refined(rows, sets, LEVELS, DEEPER, unpack), "deeper")
        for level in range(LEVELS):
            rows = deep.select(F.col("keys")[level].alias("region"), "node", "keys")
            sizes = materialize(S.region_sizes(rows), "regions")
            members.append(S.bounded_regions(rows, sizes, limit))
            large = sizes.where(F.col("n") > limit).select("region", "n")
            deep = materialize(rows.join(large.select("region"), "region").select("keys", "node"), "deeper")
        members.append(S.blocked(deep.select(F.col("keys")[LEVELS - 1].alias("region"), "node"), large, limit))
    out = members[0]
    for more in members[1:]:
        out = out.unionByName(more)
    return out, sets, crowded


def forest_links(sketch: DataFrame, sets_of, percent: int, unpack: S.Unpack = S.unpack) -> DataFrame:
    """Links (a, b) between the nodes of `sketch` that connect all that share a
    region and are linked. `unpack` reads the sets that `sets_of` gives."""
    members, sets, crowded = forest_regions(sketch, sets_of, unpack=unpack)
    links = S.linked(members, sets, percent, unpack)
    if crowded.isEmpty():
        return links
    links = materialize(links, "links")
    parts = crowded.join(components(links, "a", "b"), "node", "left").select("node", F.coalesce("root", "node").alias("part"))
    crowd = materialize(parts.join(sets, "node").select("node", "part", "set"), "crowd")
    return links.unionByName(prefix_links(crowd, percent, unpack=unpack))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """One row per row of `docs`: id_col, n_shingles, component_id (the smallest
    id reachable over links of at least `percent` Jaccard) and kept (the row's
    id is its component's)."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = materialize(
        narrow.mapInArrow(_sketched(words, trees, depth), f"id {kind}, n long, one long, two long, keys binary"), "sketch"
    )
    same = ["n", "one", "two"]
    classes = materialize(
        sketch.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("node"), F.any_value("keys").alias("keys")), "classes"
    )
    shared = materialize(sketch.where("id is not null").groupBy("id").count().where("count > 1").select("id"), "shared")

    def sets_of(nodes: DataFrame) -> DataFrame:
        found = narrow.where("id is not null").select("id", "text", F.xxhash64("id").alias("h"))
        packed = found.mapInArrow(_packed(words, bit_table(nodes, "node")), f"node {kind}, set binary")
        return packed if shared.isEmpty() else packed.dropDuplicates(["node"])

    links = forest_links(classes.select("node", "keys"), sets_of, percent)
    # Classes of one id (rows that share it) are one document.
    roots = components(links.unionByName(_shared_ids(sketch, classes, shared)), "a", "b")
    named = classes.select(*same, "node").join(roots, "node", "left")
    named = named.select(*same, F.coalesce("root", "node").alias("component"))
    out = sketch.select("id", *same).join(named, same, "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _shared_ids(sketch: DataFrame, classes: DataFrame, shared: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    own = sketch.where("n > 0").join(shared, "id").join(classes.select("n", "one", "two", "node"), ["n", "one", "two"])
    return own.select(F.col("id").alias("a"), F.col("node").alias("b")).distinct()


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each component; rows without id all stay."""
    found = near_duplicates(docs, id_col, text_col, **options)
    keep = found.where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(keep, F.col(id_col) == F.col("__id"), "left_semi")
    return named.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))
