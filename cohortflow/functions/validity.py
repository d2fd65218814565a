"""The three as-of validity rules for interval-valued rows (null end = still open).

They differ on purpose and each metric uses exactly one of them; keep them
separate so a metric can never pick up another's boundary by accident.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for "still open" when interval ends are collapsed with max().
OPEN_END = "9999-12-31"


def valid_half_open(start: Column, end: Column, t: Column) -> Column:
    """start <= t and (end > t or end is null) -- mentored flag."""
    return (start <= t) & (end.isNull() | (end > t))


def valid_closed(start: Column, end: Column, t: Column) -> Column:
    """start <= t and (end >= t or end is null) -- mentees, contact chart, schedules."""
    return (start <= t) & (end.isNull() | (end >= t))


def alive_at(end: Column, t: Column) -> Column:
    """end is null or end >= t; the start is not tested (look-ahead kept, Q9)."""
    return end.isNull() | (end >= t)


def open_end(end: Column) -> Column:
    """End date with null mapped to a far-future date, so max() keeps "open"."""
    return F.coalesce(end, F.lit(OPEN_END).cast("date"))
