"""Academic calendar: 12 months x (pre-window start, post-window end, fiscal year)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortflow.functions.calendar import DEFAULT_CALENDAR, AcademicCalendar

D = dt.date

# (event date, pre-window start, post-window end, fiscal year), one date per month in 2015.
EXPECTED = [
    (D(2015, 1, 15), D(2014, 9, 1), D(2015, 10, 1), 2015),
    (D(2015, 2, 15), D(2014, 9, 1), D(2015, 10, 1), 2015),
    (D(2015, 3, 15), D(2014, 10, 1), D(2015, 11, 1), 2015),
    (D(2015, 4, 15), D(2014, 11, 1), D(2015, 12, 1), 2015),
    (D(2015, 5, 15), D(2015, 2, 1), D(2015, 12, 1), 2015),
    (D(2015, 6, 15), D(2015, 2, 1), D(2015, 12, 1), 2016),
    (D(2015, 7, 15), D(2015, 2, 1), D(2015, 12, 1), 2016),
    (D(2015, 8, 15), D(2015, 2, 1), D(2015, 12, 1), 2016),
    (D(2015, 9, 15), D(2015, 2, 1), D(2016, 2, 1), 2016),
    (D(2015, 10, 15), D(2015, 3, 1), D(2016, 3, 1), 2016),
    (D(2015, 11, 15), D(2015, 4, 1), D(2016, 4, 1), 2016),
    (D(2015, 12, 15), D(2015, 9, 1), D(2016, 5, 1), 2016),
]


@pytest.fixture(scope="module")
def windows(spark):
    df = spark.createDataFrame([(r[0],) for r in EXPECTED], "d date")
    c = DEFAULT_CALENDAR
    rows = df.select("d", c.window_start(F.col("d")).alias("b"), c.window_end(F.col("d")).alias("a"),
                     c.fiscal_year(F.col("d")).alias("fy")).collect()
    return {r.d: (r.b, r.a, r.fy) for r in rows}


@pytest.mark.parametrize("row", EXPECTED, ids=[f"m{r[0].month}" for r in EXPECTED])
def test_window_start(windows, row):
    assert windows[row[0]][0] == row[1]


@pytest.mark.parametrize("row", EXPECTED, ids=[f"m{r[0].month}" for r in EXPECTED])
def test_window_end(windows, row):
    assert windows[row[0]][1] == row[2]


@pytest.mark.parametrize("row", EXPECTED, ids=[f"m{r[0].month}" for r in EXPECTED])
def test_fiscal_year(windows, row):
    assert windows[row[0]][2] == row[3]


def test_c9_reference_smoke_date(spark):
    """`10/3/2015` (3 October): windows 2015-03-01 .. 2016-03-01, FY 2016."""
    from cohortflow.functions.dates import parse_date_text

    c = DEFAULT_CALENDAR
    r = spark.createDataFrame([("10/3/2015",)], "s string").select(parse_date_text(F.col("s")).alias("d")).select(
        "d", c.window_start(F.col("d")).alias("b"), c.window_end(F.col("d")).alias("a"), c.fiscal_year(F.col("d")).alias("fy")
    ).first()
    assert (r.d, r.b, r.a, r.fy) == (D(2015, 10, 3), D(2015, 3, 1), D(2016, 3, 1), 2016)


def test_calendar_frame_and_validation(spark):
    assert DEFAULT_CALENDAR.as_frame(spark).count() == 12
    with pytest.raises(ValueError):
        AcademicCalendar.from_mapping({1: (0, 1, 0, 1, 0)})
