"""Per-member facts that take no date: gathered into one table with one shuffle.

Each source contributes raw rows ``(user_id, <its columns>)`` and the
aggregates that reduce them. `combine` stacks the rows of all sources
(missing columns are null) and runs every aggregate in a single groupBy, so
the partial aggregation of each source happens before the one shuffle on
user_id, instead of one aggregation plus one join per metric.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MemberFacts:
    rows: DataFrame
    aggs: tuple[Column, ...]

    def table(self) -> DataFrame:
        return combine([self])


def combine(parts: list[MemberFacts]) -> DataFrame:
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.rows for p in parts])
    rows = rows.where(F.col("user_id").isNotNull())
    return rows.groupBy("user_id").agg(*[a for p in parts for a in p.aggs])
