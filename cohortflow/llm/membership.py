"""A bounded bit table of a set of nodes, for dropping most other rows before a shuffle.

Rows whose node is in the set always pass; of the others, at most a few in a
hundred do while the set has fewer than `1 << MAX_BITS` / 16 nodes, and more
beyond that. So it only saves work: an exact join must follow. The table's
size is bounded whatever the set's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 27  # 16 MB


def bit_table(nodes: DataFrame, column: str, hashed: bool = False):
    """Broadcast of the bit table of `column`'s values, which may be hashes already."""
    count = nodes.count()
    words = 1 << (min(MAX_BITS, max(16, (16 * count).bit_length())) - 6)
    hashes = nodes.select((F.col(column) if hashed else F.xxhash64(column)).alias("h"))
    bits = hashes.groupBy(F.expr(f"pmod(shiftright(h, 6), {words})").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("bits"))
    rows = bits.toPandas()  # at most `words` rows
    table = np.zeros(words, dtype=np.uint64)
    table[rows.word.to_numpy(dtype=np.int64)] = rows.bits.to_numpy(dtype=np.int64).view(np.uint64)
    return nodes.sparkSession.sparkContext.broadcast(table)


def passing(table: np.ndarray, hashes: pa.Array) -> pa.Array:
    """Mask of the rows whose hash is in the table."""
    h = hashes.to_numpy(zero_copy_only=False).astype(np.int64)
    word = table[(h >> 6) % len(table)]
    return pa.array((word >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1)
