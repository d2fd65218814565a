"""Global row numbers and running sums without a one-task window.

Rows are range-partitioned on the wanted order and written once. Row numbers
and running sums are taken inside each partition, and each partition adds the
totals of the partitions before it. The only one-task step sums one row per
partition, so its size is the number of shuffle partitions, not the data's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

PART, COUNT = "__part", "__part_rows"


def ordered_totals(df: DataFrame, order_by: list[Column], rank: str, sums: dict[str, str] | None = None) -> DataFrame:
    """`df` with `rank` (0-based position in `order_by`) and, for each
    `{name: column}` of `sums`, the sum of `column` over all rows before.

    `order_by` should be a total order; tied rows get distinct ranks in an
    unspecified order among themselves. Null values in a summed column count 0.
    An empty input gives an empty result.
    """
    sums = sums or {}
    ranged = df.repartitionByRange(*order_by).withColumn(PART, F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    totals = ranged.groupBy(PART).agg(
        F.count(F.lit(1)).alias(COUNT),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"__total_{name}") for name, c in sums.items()],
    )
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = totals.select(
        PART,
        F.coalesce(F.sum(COUNT).over(before), F.lit(0)).alias("__base_rank"),
        *[F.coalesce(F.sum(f"__total_{name}").over(before), F.lit(0)).alias(f"__base_{name}") for name in sums],
    )
    inside = Window.partitionBy(PART).orderBy(*order_by)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.select(
        "*",
        (F.row_number().over(inside) - 1).alias("__inner_rank"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__inner_{name}") for name, c in sums.items()],
    )
    return inner.join(bases, PART).select(
        *df.columns,
        (F.col("__base_rank") + F.col("__inner_rank")).cast("long").alias(rank),
        *[(F.col(f"__base_{name}") + F.col(f"__inner_{name}")).alias(name) for name in sums],
    )
