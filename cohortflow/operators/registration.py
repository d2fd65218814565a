"""Registering a batch: events and attendees from the registration file.

Set-based and idempotent: a batch appended twice adds nothing (Q12), ids are
numbered only over events that are new, ordered by natural key.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Union

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import parse_date_text, unparseable
from ..sources.scratch import materialize
from ..sources.tables import MALFORMED
from .ranking import ordered_totals

EVENT_KEY = ["event", "start_date", "end_date"]

TypeId = Union[int, Column, Callable[[Column], Column]]


def parse_registrations(raw: DataFrame) -> DataFrame:
    """Text dates -> DateType, user id -> bigint, reject flag (Q17).

    A row is rejected when a date text is unreadable, or when its line was
    malformed (`tables.MALFORMED`, where the source has that column).
    Output: user_id, event, start_date, end_date, start_text, end_text,
    malformed, rejected.
    """
    malformed = F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(None).cast("string")
    rows = raw.select(
        F.col("member_id").try_cast("bigint").alias("user_id"),
        "event",
        parse_date_text(F.col("start_date")).alias("start_date"),
        parse_date_text(F.col("end_date")).alias("end_date"),
        F.col("start_date").alias("start_text"),
        F.col("end_date").alias("end_text"),
        malformed.alias(MALFORMED),
        *(["screened"] if "screened" in raw.columns else []),
    )
    bad = unparseable(F.col("start_text"), F.col("start_date")) | unparseable(F.col("end_text"), F.col("end_date"))
    return rows.withColumn("rejected", bad | F.col(MALFORMED).isNotNull())


@dataclass(frozen=True)
class ParsedBatch:
    """Parsed rows, written once, and what was counted on the way."""

    rows: DataFrame
    raw_rows: int  # rows that passed the screen
    screened_rows: int  # rows that the screen took out
    rejected_rows: int
    malformed_rows: int  # of the rejected ones


def parsed_once(raw: DataFrame, screen: bool = False, staff: DataFrame | None = None) -> ParsedBatch:
    """`parse_registrations`, after `screen_registrations` where asked, written once:
    every date text is parsed one time however often the rows are read.

    The counts that need no join (A10) are observed while the rows are written,
    in the writing stage, so no row is read again for them and a task that runs
    twice counts once.
    """
    rows = parse_registrations(screened(raw, staff) if screen else raw.withColumn("screened", F.lit(False)))
    seen = Observation()
    kept = ~F.col("screened")
    observed = rows.observe(
        seen,
        F.count_if(kept).alias("raw_rows"),
        F.count_if("screened").alias("screened_rows"),
        F.count_if(kept & F.col("rejected")).alias("rejected_rows"),
        F.count_if(kept & F.col(MALFORMED).isNotNull()).alias("malformed_rows"),
    )
    written = materialize(observed.where(kept).drop("screened"), "parsed")
    return ParsedBatch(written, **seen.get)


def accepted(parsed: DataFrame) -> DataFrame:
    """Typed registrations whose dates all parsed: (user_id, event, start_date, end_date)."""
    return parsed.where(~F.col("rejected")).select("user_id", "event", "start_date", "end_date")


def rejected(parsed: DataFrame) -> DataFrame:
    """The reject table: rows with date text that no accepted format reads, and
    malformed lines, which have only their text."""
    return parsed.where(F.col("rejected")).select(
        "user_id", "event", F.col("start_text").alias("start_date"), F.col("end_text").alias("end_date"), MALFORMED
    )


def screened(raw: DataFrame, staff: DataFrame | None = None) -> DataFrame:
    """`raw` with `screened`, whether the written preparation rules drop the row.

    They drop names containing CANCELLED (any case) or any non-ASCII character,
    and, when `staff` (a frame with `id`) is given, rows of staff members. Null
    names and null user ids are kept; later steps decide about them.
    """
    name = F.col("event")
    cancelled = F.coalesce(F.upper(name).contains("CANCELLED"), F.lit(False))
    odd = F.coalesce(name.rlike("[^\\x00-\\x7F]"), F.lit(False))
    if staff is None:
        return raw.withColumn("screened", cancelled | odd)
    user = F.col("member_id") if "member_id" in raw.columns else F.col("user_id")
    keyed = raw.withColumn("_uid", user.try_cast("bigint"))
    staff_ids = staff.select(F.col("id").alias("_uid"), F.lit(True).alias("_staff")).distinct()
    of_staff = F.coalesce(F.col("_staff"), F.lit(False))
    return keyed.join(staff_ids, "_uid", "left").withColumn("screened", cancelled | odd | of_staff).drop("_uid", "_staff")


def screen_registrations(raw: DataFrame, staff: DataFrame | None = None) -> DataFrame:
    """The rows that the written preparation rules keep (see `screened`)."""
    return screened(raw, staff).where(~F.col("screened")).drop("screened")


def batch_events(registrations: DataFrame) -> DataFrame:
    """D1 + F1 on typed rows: distinct (event, start_date, end_date), no nulls.

    Dates are parsed before this step, so one event written two ways is one
    event (Q21).
    """
    return registrations.select(*EVENT_KEY).distinct().dropna(how="any")


def _type_column(type_id: TypeId) -> Column:
    if isinstance(type_id, int):
        return F.lit(type_id)
    if isinstance(type_id, Column):
        return type_id
    return type_id(F.col("event"))


def new_program_events(batch: DataFrame, existing: DataFrame | None, type_id: TypeId) -> DataFrame:
    """Events of the batch that the store does not hold yet, with new ids.

    Ids continue after the store's largest id (scalar subquery, no collect),
    numbered in natural-key order by range-partitioned prefix sums, so no task
    holds all new events.
    Output: id, name, type_id, start_date, end_date.
    """
    new = batch
    base: Column = F.lit(0).cast("bigint")
    if existing is not None:
        stored = existing.select(F.col("name").alias("event"), "start_date", "end_date")
        new = batch.join(stored, EVENT_KEY, "left_anti")
        base = F.coalesce(existing.select(F.max("id")).scalar(), F.lit(0)).cast("bigint")
    numbered = ordered_totals(new, [F.col(c) for c in EVENT_KEY], "place")
    return numbered.select(
        (base + F.col("place") + 1).cast("bigint").alias("id"),
        F.col("event").alias("name"),
        _type_column(type_id).cast("int").alias("type_id"),
        "start_date",
        "end_date",
    )


def resolve_event_ids(batch: DataFrame, events: DataFrame) -> DataFrame:
    """Batch events -> their stored ids on the full natural key.

    Output: event, start_date, end_date, event_id.
    """
    stored = events.select(
        F.col("id").alias("event_id"), F.col("name").alias("event"), "start_date", "end_date"
    )
    return batch.select(*EVENT_KEY).join(stored, EVENT_KEY)


def registration_attendees(registrations: DataFrame, events: DataFrame) -> DataFrame:
    """Attendees of stored events, one row per (event_id, user_id).

    Matches on (name, start_date) only; the end date comes from the event, so a
    registration without an end date still matches (Q14) and a name/start pair
    stored with two end dates attaches the person to both (Q15). Nulls never
    match (Q13). D2 keeps one row per (event, start, end, user), the smallest id.
    """
    regs = registrations.select(F.col("user_id").cast("bigint").alias("user_id"), "event", "start_date")
    stored = events.select(F.col("id").alias("event_id"), F.col("name").alias("event"), "start_date", "end_date")
    joined = regs.join(stored, ["event", "start_date"]).where(F.col("user_id").isNotNull())
    return joined.groupBy("event", "start_date", "end_date", "user_id").agg(F.min("event_id").alias("event_id")).select(
        "event_id", "user_id"
    )


def new_event_attendees(attendees: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Attendee rows not stored yet (idempotent append)."""
    if existing is None:
        return attendees
    return attendees.join(existing.select("event_id", "user_id"), ["event_id", "user_id"], "left_anti")


def registration_summary(parsed: ParsedBatch, events: DataFrame | None = None) -> DataFrame:
    """A10: the run counts as one row.

    raw_rows: rows of the file that passed the screen; screened_rows: rows the
    screen took out; rejected_rows: malformed rows and rows with unreadable date
    text; malformed_rows: the former; attendees_before: attendee rows before the
    join. These were counted while the rows were written.
    unique_events: distinct complete events after parsing; attendees_after:
    (event, start, end, user) left after the join, null-id drop and dedup;
    batch_events: events of the batch that have an id. The join is against
    `events` when given, else against the batch's own events.
    """
    good = accepted(parsed.rows)
    batch = batch_events(good)
    held = batch if events is None else events.select(F.col("name").alias("event"), "start_date", "end_date").distinct()
    known = good.where(F.col("user_id").isNotNull()).select("user_id", "event", "start_date").distinct()
    attendees = known.join(held, ["event", "start_date"])
    in_batch = batch if events is None else batch.join(held, EVENT_KEY, "left_semi")
    size = lambda df: df.agg(F.count(F.lit(1))).scalar()
    counted = {
        "raw_rows": parsed.raw_rows, "screened_rows": parsed.screened_rows, "rejected_rows": parsed.rejected_rows,
        "malformed_rows": parsed.malformed_rows, "attendees_before": parsed.raw_rows - parsed.rejected_rows,
    }
    one = good.sparkSession.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counted.items()])
    return one.select("*", size(batch).alias("unique_events"), size(attendees).alias("attendees_after"), size(in_batch).alias("batch_events"))


def event_report(events: DataFrame) -> DataFrame:
    """O1: the stored events ordered by name, then dates, for a readable listing.

    A global sort (range-partitioned), so it is kept out of every plan that
    only needs the set of events.
    """
    return events.orderBy("name", "start_date", "end_date")
