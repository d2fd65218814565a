"""Academic calendar around a program event (pre-window start, post-window end, fiscal year).

The windows are academic terms, not a fixed number of days. The calendar is a
12-row table keyed by month; `AcademicCalendar` turns it into column
expressions (`element_at` over literal arrays) so the lookup stays inside
whole-stage codegen with no join. A caller can pass another table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal the reference's calendar).
# month: (pre-window start year offset, pre-window start month,
#         post-window end year offset, post-window end month,
#         fiscal-year offset)
# Pre-window start is taken from the event's start date; post-window end and
# fiscal year from its end date. All windows begin/end on the 1st of a month.
ACADEMIC_CALENDAR: dict[int, tuple[int, int, int, int, int]] = {
    1: (-1, 9, 0, 10, 0),
    2: (-1, 9, 0, 10, 0),
    3: (-1, 10, 0, 11, 0),
    4: (-1, 11, 0, 12, 0),
    5: (0, 2, 0, 12, 0),
    6: (0, 2, 0, 12, 1),
    7: (0, 2, 0, 12, 1),
    8: (0, 2, 0, 12, 1),
    9: (0, 2, 1, 2, 1),
    10: (0, 3, 1, 3, 1),
    11: (0, 4, 1, 4, 1),
    12: (0, 9, 1, 5, 1),
}


@dataclass(frozen=True)
class AcademicCalendar:
    table: tuple[tuple[int, int, int, int, int], ...]

    @classmethod
    def from_mapping(cls, mapping: dict[int, tuple[int, int, int, int, int]]) -> "AcademicCalendar":
        if sorted(mapping) != list(range(1, 13)):
            raise ValueError("calendar needs exactly one row per month 1..12")
        return cls(tuple(mapping[m] for m in range(1, 13)))

    def _pick(self, field: int, month: Column) -> Column:
        return F.element_at(F.array(*[F.lit(row[field]) for row in self.table]), month)

    def window_start(self, start_date: Column) -> Column:
        """First day of the pre-event window."""
        m = F.month(start_date)
        return F.make_date(F.year(start_date) + self._pick(0, m), self._pick(1, m), F.lit(1))

    def window_end(self, end_date: Column) -> Column:
        """Last day of the post-event window, `3_mo_after`."""
        m = F.month(end_date)
        return F.make_date(F.year(end_date) + self._pick(2, m), self._pick(3, m), F.lit(1))

    def fiscal_year(self, end_date: Column) -> Column:
        """Fiscal year of the event (X3), from its end date."""
        return (F.year(end_date) + self._pick(4, F.month(end_date))).cast("int")

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """The calendar as a 12-row DataFrame (for reports and inspection)."""
        rows = [(m, *row) for m, row in enumerate(self.table, start=1)]
        return spark.createDataFrame(
            rows,
            "month int, before_year_offset int, before_month int, "
            "after_year_offset int, after_month int, fy_offset int",
        )


DEFAULT_CALENDAR = AcademicCalendar.from_mapping(ACADEMIC_CALENDAR)
