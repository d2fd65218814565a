"""Plan shape: JVM-only operators, no cartesian or nested-loop joins, pushed-down scans,
and results that do not depend on the number of shuffle partitions."""

from __future__ import annotations

import pytest

from conftest import SF001
from cohortflow.queries import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_nested_loops(spark, name):
    text = _plan_text(QUERIES[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in text, op


def test_filters_reach_the_parquet_scan(spark):
    text = _plan_text(QUERIES["leaders_in_chain"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_orderkey)]" in text
    # column pruning: the orders scan for study groups reads only what it uses
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text


def test_no_window_over_all_rows(spark):
    """Windows without a partition key only see one row per partition (prefix sums)."""
    from cohortflow.operators.ranking import PART

    for name in sorted(QUERIES):
        text = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        for line in text.splitlines():
            if "Window [" in line and "windowspecdefinition(" in line:
                assert PART in line or "windowspecdefinition(user_id" in line or "windowspecdefinition(kind" in line \
                    or "windowspecdefinition(name" in line or "windowspecdefinition(leader_id" in line, line


@pytest.mark.parametrize("name", ["attendance_before", "attendance_after", "mentored_as_of", "mentor_activity", "leaders_in_chain"])
def test_no_range_residual(spark, name):
    """Dates are compared by sorting, never as a condition of a join."""
    joins = [line for line in _plan_text(QUERIES[name](spark, SF001)).splitlines() if "Join" in line]
    assert joins and not any("_date" in line or " lo" in line or "<=" in line for line in joins)


def test_one_attendance_pass(spark):
    """attendance x sessions is scanned, joined and reduced in one branch."""
    from cohortflow.config import FIXTURE_RULES
    from cohortflow.operators import attendance
    from cohortflow.sources import fixtures as fx

    inputs = fx.fixture_inputs(spark, SF001)
    facts = attendance.window_facts(attendance.session_facts(inputs.attendance, inputs.sessions))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert FIXTURE_RULES is not None


def test_event_dimension_and_cohort_are_read_back(spark):
    """The flagship's plan neither numbers events nor resolves the cohort again."""
    plan = QUERIES["event_dataset"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 49  # half of the 98 of the plan that rebuilt them per use
    assert "o_orderpriority" not in plan


def test_result_independent_of_partition_count(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(map(tuple, QUERIES["event_dataset"](spark, SF001).collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = sorted(map(tuple, QUERIES["event_dataset"](spark, SF001).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and len(a) > 0


def test_event_report_orders_by_name_then_dates(spark):
    from builders import D
    from cohortflow.operators.registration import event_report
    from cohortflow.sources.schemas import PROGRAM_EVENT

    events = spark.createDataFrame(
        [(3, "b", 1, D(2015, 1, 1), D(2015, 1, 2)), (1, "a", 1, D(2016, 1, 1), D(2016, 1, 2)),
         (2, "a", 1, D(2015, 1, 1), D(2015, 1, 2))],
        PROGRAM_EVENT,
    )
    assert [r.id for r in event_report(events).collect()] == [2, 1, 3]
