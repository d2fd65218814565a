"""Hand-made cases for rules the fixture does not reach (FIXTURES.md section C)."""

from __future__ import annotations

import pytest

from builders import D, make_inputs, member
from cohortflow.config import CohortRules
from cohortflow.plans.profiles import CohortPlan

RULES = CohortRules(excluded_regions=(9,))

# Event 1: 2015-10-03..2015-10-05 -> pre window [2015-03-01, 2015-10-03], post [2015-10-05, 2016-03-01].
# Event 2: one-day event 2015-10-10 -> pre [2015-03-01, 2015-10-10], post [2015-10-10, 2016-03-01].
# Event 3: 2016-06-05..2016-06-08 -> post window end 2016-12-01, FY 2017.
EVENTS = [
    (1, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 5)),
    (2, "Day", 1, D(2015, 10, 10), D(2015, 10, 10)),
    (3, "Summer", 1, D(2016, 6, 5), D(2016, 6, 8)),
]
T1 = D(2015, 10, 3)

MEMBERS = [member(u) for u in (10, 11, 12, 13, 14, 20, 21, 22, 30, 31, 50, 60)] + [
    member(40, year=None),
    member(41, role=None),
    member(42, campus=2),
    member(43, campus=None),
]
ATTENDEES = [(1, u) for u in (10, 11, 13, 14, 20, 30, 40, 41, 42, 43, 50, 60)] + [(2, 12), (1, 12), (3, 12)]

SESSIONS = [
    (500, D(2015, 6, 1), 7),  # cancelled, in event 1's pre window
    (501, D(2014, 1, 1), None),  # outside every window
    (502, D(2015, 10, 10), None),  # the one-day event's day
    (503, D(2015, 6, 1), None),
    (504, D(2015, 7, 1), None),
    (505, D(2015, 11, 1), None),
    (506, D(2016, 9, 1), None),
]
ATTENDANCE = [
    (100, 10, 500, 1),  # C1: only row, cancelled, in window
    (110, 11, 500, 1),  # C2: cancelled in window ...
    (111, 11, 501, 1),  # ... plus one row outside the window
    (120, 12, 502, 1),  # C3
    (121, 12, 506, 1),  # event 3 post window only
    # id 600 on two sessions / days (non-unique id): counted once per window.
    (600, 50, 503, 1),
    (600, 50, 504, 1),
    (600, 50, 505, 1),
    (601, 50, 503, 0),
    (601, 50, 503, 0),  # exact duplicate row
]
MENTORSHIPS = [
    (1, 13, 14, D(2015, 1, 1), T1),  # C4: ends exactly at t
    (2, 20, 99, D(2014, 1, 1), None),  # C5: member 20's own mentorship, open
    (3, 21, 20, D(2016, 1, 1), None),  # C5: starts after t
    (4, 22, 21, D(2016, 6, 1), None),  # C5: third level, starts after t
    (5, 30, 98, D(2014, 1, 1), None),  # C6: own mentorship open
    (6, 31, 30, D(2014, 1, 1), D(2015, 1, 1)),  # C6: only mentee line ended before t
]
OUTCOMES = [(60, 1), (60, 0), (60, None)]  # C12


@pytest.fixture(scope="module")
def plan(spark):
    inputs = make_inputs(
        spark,
        program_event=EVENTS,
        program_event_type=[(1, "Missions")],
        event_attendees=ATTENDEES,
        members=MEMBERS,
        org_units=[(1, "Campus A", 1), (2, "Campus B", None)],
        sessions=SESSIONS,
        attendance=ATTENDANCE,
        mentorships=MENTORSHIPS,
        outreach_outcomes=OUTCOMES,
    )
    return CohortPlan(inputs, RULES)


def _rows(df, key=("event_id", "user_id")):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def m1(plan):
    return _rows(plan.pre_event_profile())


@pytest.fixture(scope="module")
def m2(plan):
    return _rows(plan.post_event_profile())


@pytest.fixture(scope="module")
def l1(plan):
    return _rows(plan.leadership_profile("start"))


@pytest.fixture(scope="module")
def m5(plan):
    return {(r["event_name"], r["user_id"]): r.asDict() for r in plan.event_dataset().collect()}


def test_c1_all_rows_cancelled_in_window_drops_pre_row(m1, m2):
    assert (1, 10) not in m1
    assert (m2[(1, 10)]["Attended2"], m2[(1, 10)]["Absent2"]) == (0, 0)


def test_c2_a_row_outside_the_window_keeps_the_member(m1):
    r = m1[(1, 11)]
    assert (r["count_BSAtt"], r["count_BSAb"]) == (0, 0)
    # the earliest attended day reads all history, also outside the batch's time span
    assert r["earliest_BSA"] == D(2014, 1, 1)


def test_c3_one_day_event_counts_in_both_windows(m1, m2):
    assert m1[(2, 12)]["count_BSAtt"] == 1
    assert m2[(2, 12)]["Attended2"] == 1


def test_c4_end_equal_to_t(m1, l1):
    assert m1[(1, 13)]["Was_D_at_start"] == 0
    assert l1[(1, 14)]["number_of_D_at_start"] == 1


def test_c5_later_mentorships_count_for_second_generation_only(l1):
    r = l1[(1, 20)]
    assert r["has_second_generation"] == 1
    assert r["number_of_D_at_start"] == 0


def test_c6_only_ended_mentee_lines_give_null(l1):
    assert l1[(1, 30)]["has_second_generation"] is None


def test_c8_each_event_row_keeps_its_own_values(m5):
    a, b = m5[("Retreat", 12)], m5[("Summer", 12)]
    assert (a["FY"], a["3_mo_after"]) == (2016, D(2016, 3, 1))
    assert (b["FY"], b["3_mo_after"]) == (2017, D(2016, 12, 1))
    assert m5[("Day", 12)]["count_BSAtt"] == 1 and b["count_BSAtt"] == 0


def test_c11_null_rule_columns(m1, m2):
    assert (1, 40) in m1 and (1, 40) not in m2  # school year null: only the pre profile keeps it
    assert (1, 41) not in m1 and (1, 41) not in m2  # role null: dropped everywhere
    assert (1, 42) in m1 and (1, 42) not in m2  # region null


def test_c12_outcome_picks_one(m1):
    assert m1[(1, 60)]["GP_outcome"] == "1"


def test_c14_never_mentor_and_no_chart_give_null(l1):
    r = l1[(1, 11)]
    assert r["number_of_D_at_start"] is None and r["count_of_DCC"] is None and r["slbs_in_chain"] is None


def test_c18_null_campus_has_no_rows(m1, m2, l1, m5):
    assert all(k[1] != 43 for d in (m1, m2, l1) for k in d)
    assert all(k[1] != 43 for k in m5)


def test_non_unique_attendance_ids_are_counted_once_per_window(m1, m2):
    pre, post = m1[(1, 50)], m2[(1, 50)]
    assert (pre["count_BSAtt"], pre["count_BSAb"]) == (1, 1)
    assert (post["Attended2"], post["Absent2"]) == (1, 0)


def test_one_row_per_event_and_member(plan):
    for df in (plan.pre_event_profile(), plan.post_event_profile(), plan.leadership_profile("after")):
        assert df.count() == df.select("event_id", "user_id").distinct().count()


def test_dataset_keys_within_pre_profile(m1, m5):
    pre_users = {(k[0], k[1]) for k in m1}
    name_to_id = {"Retreat": 1, "Day": 2, "Summer": 3}
    assert {(name_to_id[n], u) for n, u in m5} <= pre_users


def test_d3_event_stored_under_two_ids_and_copied_rows(spark):
    """A non-idempotent loader stored one event as ids 1 and 7 (and copied rows):
    every member gets one row, under the smallest id."""
    inputs = make_inputs(
        spark,
        program_event=[EVENTS[0], EVENTS[0], (7, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 5))],
        program_event_type=[(1, "Missions")],
        event_attendees=[(1, 11), (7, 11), (7, 13), (1, 14), (1, 14), (7, 14)],
        members=MEMBERS,
        org_units=[(1, "Campus A", 1)],
    )
    rows = CohortPlan(inputs, RULES).pre_event_profile().collect()
    assert sorted((r.event_id, r.user_id) for r in rows) == [(1, 11), (1, 13), (1, 14)]


def test_q20_completed_events(spark):
    from pyspark.sql import functions as F

    from cohortflow.operators.cohort import completed_events

    events = make_inputs(spark, program_event=EVENTS).program_event
    done = completed_events(events, F.lit(D(2016, 3, 1)))
    assert sorted(r.event_id for r in done.collect()) == [1, 2]


def test_d3_batch_names_only_a_duplicate_id(spark):
    inputs = make_inputs(
        spark,
        program_event=[EVENTS[0], (7, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 5))],
        program_event_type=[(1, "Missions")],
        event_attendees=[(1, 11), (7, 13)],
        members=MEMBERS,
        org_units=[(1, "Campus A", 1)],
    )
    batch = spark.createDataFrame([(7,)], "event_id bigint")
    rows = CohortPlan(inputs, RULES, batch_event_ids=batch).pre_event_profile().collect()
    assert sorted((r.event_id, r.user_id, r.event_name) for r in rows) == [(1, 13, "Retreat")]
