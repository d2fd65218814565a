"""Query units over the driver tables: one callable (spark, sf_dir) -> DataFrame each.

Every unit reads the full driver tables through the fixture adapters; the
equivalent DuckDB SQL for each lives in `cohortflow.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import FIXTURE_RULES
from .operators import cohort, mentorship, leadership, registration as reg
from .operators.attendance import earliest_attendance, session_facts
from .plans.job import append_batch
from .plans.profiles import CohortPlan
from .sources import fixtures as fx, sinks
from .sources.schemas import EVENT_ATTENDEES
from .sources.scratch import scratch_path
from .sources.tables import read_registrations_csv

# Registrations stored before this date form the "existing" event store in the
# upsert unit; the batch is the whole registration table.
UPSERT_STORE_BEFORE = "1998-01-01"
# The stacked-batches unit splits the events in two batches at this start date.
STACK_SPLIT = "1998-01-01"


def _plan(spark: SparkSession, sf_dir: str, batch: DataFrame | None = None) -> CohortPlan:
    return CohortPlan(fx.fixture_inputs(spark, sf_dir), FIXTURE_RULES, batch_event_ids=batch)


def registration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.registration_summary(reg.parsed_once(fx.fixture_registrations_raw(spark, sf_dir)))


def registration_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registration file with damaged lines, written as text and read back;
    its reject table: unreadable dates by their values, malformed lines by their text."""
    files = scratch_path(spark, "registrations")
    fx.write_damaged_registrations(spark, sf_dir, files)
    return reg.rejected(reg.parsed_once(read_registrations_csv(spark, files)).rows)


def damaged_registration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 over the registration file with damaged lines."""
    files = scratch_path(spark, "registrations")
    fx.write_damaged_registrations(spark, sf_dir, files)
    return reg.registration_summary(reg.parsed_once(read_registrations_csv(spark, files)))


def registration_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fx.fixture_inputs(spark, sf_dir)
    staff = inputs.members.where(F.col("user_role_type_id").isin(*FIXTURE_RULES.excluded_roles))
    return reg.screen_registrations(fx.fixture_registrations_raw(spark, sf_dir), staff)


def parsed_registration_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.parse_registrations(fx.fixture_registrations_raw(spark, sf_dir))


def program_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.program_event(fx.fixture_registrations(spark, sf_dir))


def program_events_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = fx.fixture_registrations(spark, sf_dir)
    stored = reg.new_program_events(
        reg.batch_events(regs.where(F.col("start_date") < F.lit(UPSERT_STORE_BEFORE).cast("date"))), None, fx.fixture_type_id
    )
    return reg.new_program_events(reg.batch_events(regs), stored, fx.fixture_type_id)


def attendees_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registration file is written as CSV and read back by name, the
    registrations before the split date are published to a store, and the whole file
    is then registered against it. The rows it appended: event_id, user_id."""
    files, store = scratch_path(spark, "registrations"), scratch_path(spark, "store")
    fx.fixture_registrations_raw(spark, sf_dir).write.option("header", True).csv(files)
    good = reg.accepted(reg.parsed_once(read_registrations_csv(spark, files)).rows)
    early = good.where(F.col("start_date") < F.lit(UPSERT_STORE_BEFORE).cast("date"))
    append_batch(spark, early, store, fx.fixture_type_id)
    before = sinks.store_version(spark, store).parts["event_attendees"]
    append_batch(spark, good, store, fx.fixture_type_id)
    after = sinks.store_version(spark, store).parts["event_attendees"]
    fresh = sinks.read_parts(spark, store, "event_attendees", tuple(part for part in after if part not in before))
    return spark.createDataFrame([], EVENT_ATTENDEES) if fresh is None else fresh


def dataset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset written twice under one dated name, first of the early
    events, then of all, and read back from its files."""
    out, run_date = scratch_path(spark, "dataset"), dt.date(2026, 12, 3)
    inputs, shared = fx.fixture_inputs(spark, sf_dir), {}
    early = inputs.program_event.where(F.col("start_date") < F.lit(STACK_SPLIT).cast("date")).select(F.col("id").alias("event_id"))
    sinks.write_dataset(CohortPlan(inputs, FIXTURE_RULES, batch_event_ids=early, shared=shared).event_dataset(), out, run_date)
    whole = CohortPlan(inputs, FIXTURE_RULES, shared=shared).event_dataset()
    path = sinks.write_dataset(whole, out, run_date)
    return spark.read.schema(whole.schema).parquet(path).select(*whole.columns)


def batch_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = reg.batch_events(reg.accepted(reg.parsed_once(fx.fixture_registrations_raw(spark, sf_dir)).rows))
    return reg.resolve_event_ids(batch, fx.program_event(fx.fixture_registrations(spark, sf_dir)))


def event_attendees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fixture_inputs(spark, sf_dir).event_attendees


def calendar_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.event_windows(fx.fixture_inputs(spark, sf_dir).program_event)


def cohort_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).cohort()


def event_type_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _plan(spark, sf_dir).cohort(with_type=True)
    return rows.groupBy("type_id", "event_type").agg(
        F.count_distinct("event_id").alias("events"), F.count(F.lit(1)).alias("attendees")
    )


def eligible_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fx.fixture_inputs(spark, sf_dir)
    return cohort.member_profiles(inputs.members, inputs.org_units, FIXTURE_RULES)


def attendance_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).attendance_before()


def attendance_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).attendance_after()


def earliest_attendance_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fx.fixture_inputs(spark, sf_dir)
    return earliest_attendance(session_facts(inputs.attendance, inputs.sessions))


def earliest_mentored(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = mentorship.as_mentee(fx.fixture_inputs(spark, sf_dir).mentorships).table()
    return facts.select("user_id", "first_became_disciple")


def mentored_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).mentored_as_of()


def outreach_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leadership.outcome(fx.fixture_inputs(spark, sf_dir).outreach_outcomes).table()


def mentor_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).mentor_activity()


def earliest_led_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fx.fixture_inputs(spark, sf_dir)
    return leadership.led_studies(inputs.study_groups, inputs.study_schedules).table()


def second_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).second_generation()


def contact_chart_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).contact_chart_depth()


def leaders_in_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).leaders_in_chain()


def pre_event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).pre_event_profile()


def post_event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).post_event_profile()


def leadership_at_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).leadership_profile("start")


def leadership_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).leadership_profile("after")


def stacked_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of M1 stacked by name; the later batch carries two extra columns."""
    inputs, shared = fx.fixture_inputs(spark, sf_dir), {}
    split = F.lit(STACK_SPLIT).cast("date")
    events = inputs.program_event
    early = events.where(F.col("start_date") < split).select(F.col("id").alias("event_id"))
    late = events.where(F.col("start_date") >= split).select(F.col("id").alias("event_id"))
    first = CohortPlan(inputs, FIXTURE_RULES, batch_event_ids=early, shared=shared).pre_event_profile()
    windows = cohort.event_windows(events).select(
        "event_id", F.col("after_date").alias("3_mo_after"), F.col("fy").alias("FY")
    )
    second = CohortPlan(inputs, FIXTURE_RULES, batch_event_ids=late, shared=shared).pre_event_profile().join(windows, "event_id")
    return first.unionByName(second, allowMissingColumns=True)


def event_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).event_dataset()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "registration_summary": registration_summary,
    "registration_rejects": registration_rejects,
    "damaged_registration_summary": damaged_registration_summary,
    "registration_screen": registration_screen,
    "parsed_registration_dates": parsed_registration_dates,
    "program_events": program_events,
    "program_events_upsert": program_events_upsert,
    "attendees_upsert": attendees_upsert,
    "dataset_files": dataset_files,
    "batch_event_ids": batch_event_ids,
    "event_attendees": event_attendees,
    "calendar_windows": calendar_windows,
    "cohort_windows": cohort_windows,
    "event_type_attendance": event_type_attendance,
    "eligible_members": eligible_members,
    "attendance_before": attendance_before,
    "attendance_after": attendance_after,
    "earliest_attendance": earliest_attendance_unit,
    "earliest_mentored": earliest_mentored,
    "mentored_as_of": mentored_as_of,
    "outreach_outcome": outreach_outcome,
    "mentor_activity": mentor_activity,
    "earliest_led_study": earliest_led_study,
    "second_generation": second_generation,
    "contact_chart_depth": contact_chart_depth,
    "leaders_in_chain": leaders_in_chain,
    "pre_event_profile": pre_event_profile,
    "post_event_profile": post_event_profile,
    "leadership_at_start": leadership_at_start,
    "leadership_after": leadership_after,
    "stacked_batches": stacked_batches,
    "event_dataset": event_dataset,
}
