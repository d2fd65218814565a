"""The batch job: register a registration file, then measure its events.

1. read the file (S1), parse dates, reject malformed rows and unreadable dates
   (Q17), optionally apply the written preparation screen (F13);
2. write the events the store lacks, numbered after the largest stored id (S4);
3. write the attendees the store lacks (S5), and publish both as the store's next
   version at once; a failed run leaves the version before, and is run again;
4. read the stores back (S3) and build the wide dataset for the batch's
   events over all their stored attendees (Q16);
5. write the dataset under a dated name (S6, S7), plus the reject table and
   the run counts (A10).

Runs may overlap: the second to publish a version number registers its batch
again, against the first one's version. The store writes are the lineage cut
between registering and measuring; parsed rows, event dimension and
cohort are written once to the cluster's shared `spark.checkpoint.dir`, so the
branches that read them share one copy and a lost executor costs at most the
stage it ran.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CohortRules
from ..functions.calendar import DEFAULT_CALENDAR, AcademicCalendar
from ..operators import cohort
from ..operators import registration as reg
from ..sources import sinks
from ..sources.schemas import NATIVE_TABLES
from ..sources.tables import read_native_tables, read_registrations_csv
from ..sources.scratch import materialize
from .profiles import CohortPlan


# The tables whose bytes decide the number of shuffle partitions.
FACT_TABLES = ("attendance", "sessions", "mentorships", "study_groups", "study_schedules", "contact_chart", "event_attendees")
# How often a batch is registered anew because another run published first.
ATTEMPTS = 5


@dataclass(frozen=True)
class RegisteredBatch:
    batch_event_ids: DataFrame  # event, start_date, end_date, event_id
    rejects: DataFrame
    summary: DataFrame


def register_batch(
    spark: SparkSession,
    raw: DataFrame,
    store_path: str,
    type_id: reg.TypeId,
    staff: DataFrame | None = None,
    screen: bool = False,
) -> RegisteredBatch:
    """Steps 1-3 for one batch of raw registration rows (any source, incl. a stream batch)."""
    parsed = reg.parsed_once(raw, screen, staff)
    good = reg.accepted(parsed.rows)
    batch = reg.batch_events(good)

    for attempt in range(ATTEMPTS):
        try:
            events = append_batch(spark, good, store_path, type_id)
            break
        except sinks.StaleVersion:  # another run was faster: number and compare again, against its version
            if attempt == ATTEMPTS - 1:
                raise
    ids = materialize(reg.resolve_event_ids(batch, events), "batch_events")
    return RegisteredBatch(ids, reg.rejected(parsed.rows), reg.registration_summary(parsed, events))


def append_batch(spark: SparkSession, good: DataFrame, store_path: str, type_id: reg.TypeId) -> DataFrame:
    """What the store lacks of the batch's events and attendees, published
    together as its next version. Returns the events of that version."""
    seen = sinks.store_version(spark, store_path)
    added: dict[str, str | None] = {}
    stored = sinks.read_parts(spark, store_path, "program_event", seen.parts["program_event"])
    try:
        added["program_event"] = sinks.write_part(reg.new_program_events(reg.batch_events(good), stored, type_id), store_path, "program_event")
        parts = seen.parts["program_event"] + ((added["program_event"],) if added["program_event"] else ())
        events = sinks.read_parts(spark, store_path, "program_event", parts)
        if events is None:  # nothing stored and nothing new: an empty store
            events = spark.createDataFrame([], NATIVE_TABLES["program_event"])
        held = sinks.read_parts(spark, store_path, "event_attendees", seen.parts["event_attendees"])
        fresh = reg.new_event_attendees(reg.registration_attendees(good, events), held)
        added["event_attendees"] = sinks.write_part(fresh, store_path, "event_attendees")
        sinks.publish(spark, store_path, seen, added)
    except Exception:
        for name, part in added.items():
            sinks.drop_part(spark, store_path, name, part)
        raise
    return events


def run(
    spark: SparkSession,
    registrations_path: str,
    store_path: str,
    output_dir: str,
    type_id: int,
    run_date: dt.date,
    rules: CohortRules = CohortRules(),
    calendar: AcademicCalendar = DEFAULT_CALENDAR,
    screen: bool = False,
    fmt: str = "parquet",
    completed_only: bool = False,
    id_column: str = "member_id",
) -> str:
    raw = read_registrations_csv(spark, registrations_path, id_column)
    staff = None
    if screen:
        members = sinks.read_table_if_exists(spark, store_path, "members")
        if members is not None:
            staff = members.where(F.col("user_role_type_id").isin(*rules.excluded_roles)).select("id")
    batch = register_batch(spark, raw, store_path, type_id, staff, screen)
    stamp = run_date.strftime("%m-%d-%Y")
    batch.rejects.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/rejects_{stamp}")
    batch.summary.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/summary_{stamp}")
    stored = sinks.read_table_if_exists(spark, store_path, "program_event")
    if stored is not None:
        reg.event_report(stored).write.mode("overwrite").option("header", True).csv(f"{output_dir.rstrip('/')}/events_{stamp}")

    inputs = read_native_tables(spark, store_path, versioned={name: sinks.read_table_if_exists(spark, store_path, name) for name in sinks.VERSIONED})
    batch_ids = batch.batch_event_ids.select("event_id")
    if completed_only:  # Q20: only events whose post window has ended by the run date
        done = cohort.completed_events(inputs.program_event, F.lit(run_date), calendar)
        batch_ids = batch_ids.join(done, "event_id", "left_semi")
    plan = CohortPlan(inputs, rules, calendar, batch_event_ids=batch_ids)
    return sinks.write_dataset(plan.event_dataset(), output_dir, run_date, fmt)


def main(argv: list[str] | None = None) -> None:
    from ..session import build_session, size_for_input

    p = argparse.ArgumentParser(description="Register a registration file and build its event dataset.")
    p.add_argument("--registrations", required=True)
    p.add_argument("--store", required=True, help="base path of the native tables")
    p.add_argument("--output", required=True)
    p.add_argument("--type-id", type=int, required=True)
    p.add_argument("--run-date", default=dt.date.today().isoformat())
    p.add_argument("--screen", action="store_true", help="apply the written preparation rules")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--completed-only", action="store_true", help="only events whose post window has ended")
    p.add_argument("--id-column", default="member_id", help="the registration file's member-id column")
    a = p.parse_args(argv)
    spark = build_session()
    size_for_input(spark, sum(sinks.stored_bytes(spark, sinks.table_path(a.store, name)) for name in FACT_TABLES))
    path = run(spark, a.registrations, a.store, a.output, a.type_id, dt.date.fromisoformat(a.run_date),
               screen=a.screen, fmt=a.format, completed_only=a.completed_only, id_column=a.id_column)
    print(path)


if __name__ == "__main__":
    main()
