"""Cohort rows (one per event and attendee), their calendar windows, and member eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CohortRules
from ..functions.calendar import DEFAULT_CALENDAR, AcademicCalendar
from ..functions.decode import school_year_label


def event_windows(program_event: DataFrame, calendar: AcademicCalendar = DEFAULT_CALENDAR) -> DataFrame:
    """X1-X3 per event: event_id, before_date, start_date, end_date, after_date, fy.

    `before_date` comes from the start date; `after_date` (`3_mo_after`) and the
    fiscal year from the end date. A one-day event's day sits in both windows.
    """
    s, e = F.col("start_date"), F.col("end_date")
    return program_event.select(
        F.col("id").alias("event_id"),
        calendar.window_start(s).alias("before_date"),
        s.alias("start_date"),
        e.alias("end_date"),
        calendar.window_end(e).alias("after_date"),
        calendar.fiscal_year(e).alias("fy"),
    )


def completed_events(
    program_event: DataFrame, run_date: Column, calendar: AcademicCalendar = DEFAULT_CALENDAR
) -> DataFrame:
    """Q20: events whose post window has ended by `run_date` (output: event_id).

    The reference measures the post window even when it is still open; a
    caller may restrict a batch to completed events with this.
    """
    return event_windows(program_event, calendar).where(F.col("after_date") <= run_date).select("event_id")


def canonical_events(program_event: DataFrame) -> DataFrame:
    """Map every stored event id to the smallest id holding the same natural key (D3).

    A store written by a non-idempotent loader can hold one event under
    several ids; the dataset keeps one row per (event, start, end, member),
    measured under the smallest id (its type too). The window is partitioned
    by the natural key and runs over the event dimension only.
    Output: id, event_id (canonical), name, type_id, start_date, end_date.
    """
    same_event = Window.partitionBy("name", "start_date", "end_date")
    # Copies of an event row collapse first (partial aggregation), so neither
    # the window nor the attendee join sees them.
    events = program_event.select("id", "name", "type_id", "start_date", "end_date").distinct()
    return events.select(
        "id",
        F.min("id").over(same_event).alias("event_id"),
        "name",
        F.min_by("type_id", "id").over(same_event).alias("type_id"),
        "start_date",
        "end_date",
    )


def event_dimension(
    program_event: DataFrame,
    batch_event_ids: DataFrame | None = None,
    event_types: DataFrame | None = None,
    calendar: AcademicCalendar = DEFAULT_CALENDAR,
) -> DataFrame:
    """Stored ids of the batch's events with their canonical id, windows and (J5) type.

    With `event_types` the type join is inner: events of unknown type drop out.
    Output: id, event_id, event_name, type_id, [event_type], start_date,
    end_date, before_date, after_date, fy.
    """
    events = canonical_events(program_event)
    if batch_event_ids is not None:
        events = events.join(batch_event_ids.select(F.col("event_id").alias("id")), "id", "left_semi")
    if event_types is not None:
        types = event_types.select(F.col("id").alias("type_id"), F.col("name").alias("event_type"))
        events = events.join(types, "type_id")
    s, e = F.col("start_date"), F.col("end_date")
    return events.select(
        "id",
        "event_id",
        F.col("name").alias("event_name"),
        "type_id",
        *(["event_type"] if event_types is not None else []),
        s,
        e,
        calendar.window_start(s).alias("before_date"),
        calendar.window_end(e).alias("after_date"),
        calendar.fiscal_year(e).alias("fy"),
    )


def cohort_windows(
    event_attendees: DataFrame,
    program_event: DataFrame,
    batch_event_ids: DataFrame | None = None,
    calendar: AcademicCalendar = DEFAULT_CALENDAR,
    event_types: DataFrame | None = None,
) -> DataFrame:
    """M0: one row per (event_id, user_id) of the batch with its windows.

    All attendees stored for a batch event count, not only those in this
    run's file (Q16). `batch_event_ids` (a frame with `event_id`) limits the
    events; default is every stored event.

    A member's rows are bounded by the number of events, so later joins on
    user_id cannot concentrate a hot key on the cohort side.
    Output: event_id, user_id, event_name, type_id, [event_type], start_date,
    end_date, before_date, after_date, fy.
    """
    events = event_dimension(program_event, batch_event_ids, event_types, calendar)
    return attendee_windows(event_attendees, events)


def attendee_windows(event_attendees: DataFrame, events: DataFrame) -> DataFrame:
    """The cohort over an event dimension: canonical id and event attributes come
    in one join, then copies of an attendee row and one event stored under
    several ids (which all carry the same attributes) collapse map-side."""
    attendees = event_attendees.select(F.col("event_id").alias("id"), "user_id").where(F.col("user_id").isNotNull())
    return attendees.join(events, "id").drop("id").distinct()


def as_of_keys(cohort: DataFrame) -> DataFrame:
    """Distinct (user_id, as_of) over both dates a cohort row is measured at."""
    at_start = cohort.select("user_id", F.col("start_date").alias("as_of"))
    at_after = cohort.select("user_id", F.col("after_date").alias("as_of"))
    return at_start.unionByName(at_after).distinct()


def member_profiles(
    members: DataFrame,
    org_units: DataFrame,
    rules: CohortRules,
    apply_region: bool = True,
    apply_school_year: bool = True,
) -> DataFrame:
    """J3 + F3-F5: members that join an org unit and pass the rules in force.

    A null or unknown campus drops the member (inner join). Each rule drops
    nulls of its column, as `NOT IN` / `IN` do in SQL.
    Output: user_id, first, last, year, campus, region_id, last_login.
    """
    units = org_units.select(F.col("id").alias("campus_id"), F.col("name").alias("campus"), "region_id")
    m = members.join(units, "campus_id")
    cond = ~F.col("user_role_type_id").isin(*rules.excluded_roles)
    if apply_region:
        cond = cond & ~F.col("region_id").isin(*rules.excluded_regions)
    if apply_school_year:
        cond = cond & F.col("school_year_id").isin(*rules.school_years)
    return m.where(cond).select(
        F.col("id").alias("user_id"),
        F.col("first_name").alias("first"),
        F.col("last_name").alias("last"),
        school_year_label(F.col("school_year_id")).alias("year"),
        "campus",
        "region_id",
        "last_login",
    )
