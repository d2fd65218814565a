"""Copies and hot keys: results must not change when rows are copied many times
or when one member holds a large share of the facts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from builders import make_inputs, member
from cohortflow.config import CohortRules
from cohortflow.plans.profiles import CohortPlan
from test_bruteforce import day, expected, world

COPIES = {"event_attendees": 40, "attendance": 60, "mentorships": 30, "contact_chart": 30, "study_schedules": 20}


def _dataset(spark, w):
    inputs = make_inputs(
        spark, members=[member(u) for u in range(1, 13)], org_units=[(1, "Campus", 1)],
        program_event_type=[(1, "Missions")], **w,
    )
    rows = CohortPlan(inputs, CohortRules()).event_dataset().collect()
    return {(r["event_name"], r["user_id"]): r.asDict() for r in rows}


def _check(got, want):
    assert set(got) == set(want)
    for key, cols in want.items():
        for c, v in cols.items():
            assert got[key][c] == v, (key, c, got[key][c], v)


@pytest.mark.parametrize("seed", [3, 5])
def test_copied_rows_change_nothing(spark, seed):
    w = world(seed)
    copied = {k: (v * COPIES[k] if k in COPIES else v) for k, v in w.items()}
    _check(_dataset(spark, copied), expected(w))


def _hot_world():
    w = world(11)
    r = random.Random(7)
    hot = 1
    w["attendance"] = w["attendance"] + [
        (2000 + r.randrange(0, 400), hot, r.randrange(100, 142), r.choice([0, 1])) for _ in range(3000)
    ]
    w["contact_chart"] = w["contact_chart"] + [
        (hot, r.randrange(0, 300), day(s), None if r.random() < 0.3 else day(s + r.randrange(0, 400)))
        for s in (r.randrange(-300, 800) for _ in range(2000))
    ]
    w["mentorships"] = w["mentorships"] + [
        (500 + i, 2 + i % 11, hot, day(s), None if i % 3 == 0 else day(s + 200))
        for i, s in enumerate(r.randrange(-300, 800) for _ in range(300))
    ]
    if not any(u == hot for _, u in w["event_attendees"]):
        w["event_attendees"] = w["event_attendees"] + [(1, hot)]
    return w


def test_hot_member(spark):
    w = _hot_world()
    _check(_dataset(spark, w), expected(w))


def test_changes_are_a_row_per_member_and_day(spark):
    """What the sweep sorts of a hot member follows the days, not its intervals."""
    from cohortflow.operators import asof

    iv = spark.range(40000).selectExpr(
        "1L AS user_id", "CAST(2 AS INT) AS kind", "id AS other_id", "date_add(DATE'2015-01-01', CAST(id % 90 AS INT)) AS start_date",
        "date_add(DATE'2015-06-01', CAST(id % 30 AS INT)) AS end_date",
    )
    assert asof.changes(iv).count() == 120
    probes = spark.sql("SELECT 1L AS user_id, 10L AS event_id, DATE'2015-05-01' AS t UNION ALL SELECT 2L, 10L, DATE'2015-05-01'")
    out = asof.as_of_metrics(probes, ["event_id", "user_id"], {"k": "t"}, iv)
    assert sorted((r.event_id, r.user_id, r.contacts_k) for r in out.collect()) == [(10, 1, 40000), (10, 2, 0)]


def test_validity_at_the_ends(spark):
    """Closed intervals hold on their last day, half-open ones (MENTORED) do not; ends before
    starts never hold; an open end always does."""
    from cohortflow.operators import asof

    rows = [(1, k, 5, day(10), day(20)) for k in asof.ALL_KINDS] + [(1, k, 6, day(30), day(29)) for k in asof.ALL_KINDS]
    rows += [(1, k, 7, day(40), day(40)) for k in asof.ALL_KINDS] + [(1, k, 8, day(50), None) for k in asof.ALL_KINDS]
    iv = asof.merged_intervals(spark.createDataFrame(rows, "user_id long, kind int, other_id long, start_date date, end_date date"), ["user_id", "kind", "other_id"])
    days = [9, 10, 19, 20, 21, 29, 30, 40, 41, 49, 50, 5000]
    probes = spark.createDataFrame([(1, day(d)) for d in days], "user_id long, t date")
    out = {r.t: r for r in asof.as_of_metrics(probes, ["user_id", "t"], {"k": "t"}, iv).collect()}
    closed = {10, 19, 20, 40, 50, 5000}
    assert {d for d in days if out[day(d)].contacts_k} == closed == {d for d in days if out[day(d)].chain_k}
    assert {d for d in days if out[day(d)].mentored_k} == {10, 19, 50, 5000}


def test_merged_intervals(spark):
    from cohortflow.operators.asof import merged_intervals

    rows = [(1, day(0), day(10)), (1, day(5), day(20)), (1, day(20), day(25)), (1, day(40), day(41)), (1, day(60), None),
            (1, day(70), day(71)), (1, None, day(5)), (2, day(0), None), (2, day(0), day(3)), (3, None, None)]
    out = merged_intervals(spark.createDataFrame(rows, "k long, start_date date, end_date date"), ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, day(0), day(25)), (1, day(40), day(41)), (1, day(60), None), (2, day(0), None)], key=str
    )


def test_hot_member_with_repeated_ids(spark):
    """One member holds over a third of the attendance rows and repeats ids over many days."""
    w = _hot_world()
    r = random.Random(5)
    w["attendance"] = w["attendance"] + [(r.randrange(0, 12), 1, r.randrange(100, 142), r.choice([0, 1])) for _ in range(4000)]
    _check(_dataset(spark, w), expected(w))


def test_window_nodes_hold_each_day_once(spark):
    """The nodes that cover a window hold each of its days once and no other, for long windows too."""
    from pyspark.sql import functions as F

    from cohortflow.operators import attendance as at

    r = random.Random(2)
    spans = [(a, a + n) for a in (-700, -1, 0, 1, 255, 256, 16801) for n in (0, 1, 2, 3, 255, 256, 257, 700, 5000)]
    spans += [(a, a + r.randrange(0, 300)) for a in (r.randrange(-1000, 20000) for _ in range(60))]
    covers = spark.createDataFrame(spans, "a int, c int").select("a", "c", at._cover("a", "c").alias("cover")).collect()
    days = spark.range(-1100, 25000).select(F.col("id").cast("int").alias("d"))
    nodes = {x.d: set(x.nodes) for x in days.select("d", at._nodes_of("d").alias("nodes")).collect()}
    assert len(set().union(*nodes.values())) > len(nodes)
    for x in covers:
        assert len(x.cover) <= 2 * at.TOP + 2 + (x.c - x.a) // 256
        for d in range(x.a - 3, x.c + 3):
            assert len(nodes[d] & set(x.cover)) == (x.a <= d < x.c), (x, d)


@pytest.mark.parametrize("seed", range(3))
def test_distinct_ids_in_windows(spark, seed):
    """Ids on many days, windows of any length, members with and without links, by brute force."""
    from cohortflow.operators import attendance as at

    r = random.Random(seed)
    rows = [(r.randrange(25), r.randrange(1, 5), r.choice([0, 1]), day(r.randrange(0, 900)), r.random() < 0.1) for _ in range(600)]
    rows += [(1000 + i, 6, 1, day(r.randrange(0, 900)), False) for i in range(50)] + [(1, 7, 1, None, False)]
    facts = spark.createDataFrame(rows, "id long, user_id long, attended int, date date, cancelled boolean")
    pop = []
    for e in range(40):
        a, b = r.randrange(0, 900), r.randrange(0, 900)
        pop += [(e, u, day(a - r.randrange(0, 600)), day(a), day(b), day(b + r.randrange(-2, 600))) for u in range(1, 9)]
    probes = spark.createDataFrame(pop, "event_id long, user_id long, before_date date, start_date date, end_date date, after_date date")
    out = {(x.event_id, x.user_id): x for x in at.attendance_windows(probes, at.window_facts(facts)).collect()}
    assert len(out) == len(pop)
    for e, u, before, start, end, after in pop:
        own = [x for x in rows if x[1] == u]
        ids = lambda kind, a, b: len({x[0] for x in own if x[2] == kind and x[3] and not x[4] and a <= x[3] <= b})
        x = out[e, u]
        assert (x.attended_before, x.absent_before) == (ids(1, before, start), ids(0, before, start))
        assert (x.attended_after, x.absent_after) == (ids(1, end, after), ids(0, end, after))
        assert x.cancelled_before == sum(1 for y in own if y[4] and y[3] and before <= y[3] <= start)
        assert x.total_rows == len(own)
        assert x.earliest_attendance == min((y[3] for y in own if y[2] == 1 and y[3] and not y[4]), default=None)


def test_tasks_of_attendance_windows_hold_a_bounded_number_of_rows(spark, monkeypatch):
    from cohortflow.operators import attendance as at

    monkeypatch.setattr(at, "TASK_ROWS", 50)
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(5)]
    wfacts = spark.createDataFrame([(u, 1, d, d, 1, None) for u in range(30) for d in days], "user_id long, kind int, lo date, hi date, n long, first_day date")
    probes = spark.createDataFrame(
        [(1, u, days[0], days[2], days[2], days[4]) for u in range(30)],
        "event_id long, user_id long, before_date date, start_date date, end_date date, after_date date",
    )
    for total in (None, 180):
        out = at.attendance_windows(probes, wfacts, total)
        assert out.rdd.getNumPartitions() == 4  # 180 rows
        assert {(r.attended_before, r.attended_after) for r in out.collect()} == {(3, 3)}


def test_merged_intervals_hold_one_sort_of_their_rows(spark):
    from cohortflow.operators.asof import merged_intervals

    rows = spark.createDataFrame([(1, dt.date(2020, 1, 1), None)], "k long, start_date date, end_date date")
    plan = merged_intervals(rows, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Aggregate" not in plan


def test_plans_that_share_tables_give_the_same_rows(spark):
    from cohortflow.config import FIXTURE_RULES
    from cohortflow.plans.profiles import CohortPlan
    from cohortflow.sources.fixtures import fixture_inputs
    from conftest import SF001

    inputs, shared = fixture_inputs(spark, SF001), {}
    batch = inputs.program_event.where("id % 3 = 0").select(F.col("id").alias("event_id"))
    for ids in (batch, None):
        alone = CohortPlan(inputs, FIXTURE_RULES, batch_event_ids=ids).event_dataset()
        together = CohortPlan(inputs, FIXTURE_RULES, batch_event_ids=ids, shared=shared).event_dataset()
        assert together.exceptAll(alone).count() == 0 and alone.exceptAll(together).count() == 0 and alone.count() > 0
    assert {"member_days", "contact_chart", "contact_starts"} <= set(shared)
