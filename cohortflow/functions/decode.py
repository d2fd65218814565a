"""Code -> label decodes used in the profile columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# School-year labels by school_year_id.
SCHOOL_YEAR_LABELS = {
    1: "Freshman",
    2: "Sophomore",
    3: "Junior",
    4: "Senior",
    5: "Senior+",
    6: "Grad Student",
}

# Program event types (id, name) known to the reference.
EVENT_TYPE_NAMES = {
    1: "Missions",
    3: "Spiritual Impact Bootcamp",
    4: "Summer Projects",
    5: "Fathers House",
    6: "SEEK",
    7: "NST",
    8: "SLS",
}


def school_year_label(school_year_id: Column) -> Column:
    """Chained CASE; ids outside 1..6 (and null) give null."""
    branches = [(school_year_id == k, F.lit(v)) for k, v in SCHOOL_YEAR_LABELS.items()]
    first_cond, first_val = branches[0]
    return reduce(lambda acc, b: acc.when(b[0], b[1]), branches[1:], F.when(first_cond, first_val))


def outcome_label(outcome: Column) -> Column:
    """Outreach outcome 1 -> '1', 0 -> '0', anything else -> null."""
    return F.when(outcome == 1, F.lit("1")).when(outcome == 0, F.lit("0"))

