"""End-to-end job and streaming ingest on a store written from the smallest fixture."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from cohortflow.config import FIXTURE_RULES
from cohortflow.plans import job
from cohortflow.sources import fixtures as fx
from cohortflow.sources import sinks
from cohortflow.sources.schemas import NATIVE_TABLES
from cohortflow.sources.tables import registration_columns as job_registration_columns
from cohortflow.streaming.registrations import start_registration_ingest

RUN_DATE = dt.date(2026, 12, 3)


def _store(spark, base: str) -> None:
    inputs = fx.fixture_inputs(spark, SF001)
    for name in NATIVE_TABLES:
        if name not in ("program_event", "event_attendees"):
            getattr(inputs, name).write.mode("overwrite").parquet(sinks.table_path(base, name))


def _csv(spark, folder: str) -> None:
    fx.fixture_registrations_raw(spark, SF001).coalesce(1).write.mode("overwrite").option("header", True).csv(folder)


def _counts(spark, base: str) -> tuple[int, int]:
    ev = sinks.read_table_if_exists(spark, base, "program_event")
    at = sinks.read_table_if_exists(spark, base, "event_attendees")
    return ev.count(), at.count()


def test_job_writes_dataset_and_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-job-")
    store, regs, out = f"{root}/store", f"{root}/registrations", f"{root}/out"
    _store(spark, store)
    _csv(spark, regs)

    path = job.run(spark, regs, store, out, type_id=1, run_date=RUN_DATE, rules=FIXTURE_RULES)
    assert path.endswith("event_dataset_12-03-2026")
    first = spark.read.parquet(path)
    assert len(first.columns) == 39 and first.count() > 0
    assert spark.read.parquet(f"{out}/rejects_12-03-2026").count() > 0
    summary = spark.read.parquet(f"{out}/summary_12-03-2026").first()
    assert summary.raw_rows > summary.rejected_rows > 0 and summary.attendees_after > 0
    listed = spark.read.option("header", True).csv(f"{out}/events_12-03-2026")
    assert listed.count() == summary.batch_events
    counts = _counts(spark, store)
    ids = [r.id for r in spark.read.parquet(sinks.table_path(store, "program_event")).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))

    # The same file again adds no events or attendees and gives the same dataset.
    job.run(spark, regs, store, f"{root}/out2", type_id=1, run_date=RUN_DATE, rules=FIXTURE_RULES)
    assert _counts(spark, store) == counts
    second = spark.read.parquet(f"{root}/out2/event_dataset_12-03-2026")
    assert second.exceptAll(first).count() == 0 and first.exceptAll(second).count() == 0


def test_csv_output_and_screen(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-job-")
    store, regs, out = f"{root}/store", f"{root}/registrations", f"{root}/out"
    _store(spark, store)
    _csv(spark, regs)
    path = job.run(spark, regs, store, out, type_id=1, run_date=RUN_DATE, rules=FIXTURE_RULES, screen=True, fmt="csv")
    back = spark.read.option("header", True).csv(path)
    assert "count of DCC2" in back.columns and "3_mo_after" in back.columns
    summary = spark.read.parquet(f"{out}/summary_12-03-2026").first()
    stored = _counts(spark, store)
    # the counts are those of the rows that were registered
    assert (summary.unique_events, summary.attendees_after) == stored
    assert summary.raw_rows + summary.screened_rows == fx.fixture_registrations_raw(spark, SF001).count()
    names = spark.read.parquet(sinks.table_path(store, "program_event")).select("name").collect()
    assert not any("CANCELLED" in r.name or not r.name.isascii() for r in names)


def test_streaming_ingest_matches_batch_and_replays_nothing(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-stream-")
    store, regs = f"{root}/store", f"{root}/incoming"
    _store(spark, store)
    _csv(spark, regs)
    q = start_registration_ingest(spark, regs, store, type_id=1, checkpoint_location=f"{root}/ckpt")
    q.awaitTermination(300)
    counts = _counts(spark, store)
    assert counts[0] > 0 and counts[1] > 0

    q = start_registration_ingest(spark, regs, store, type_id=1, checkpoint_location=f"{root}/ckpt")
    q.awaitTermination(300)
    assert _counts(spark, store) == counts

    batch_root = tempfile.mkdtemp(prefix="cohortflow-job-")
    _store(spark, f"{batch_root}/store")
    job.register_batch(spark, spark.read.schema(fx.registrations_raw(spark.read.parquet(f"{SF001}/orders.parquet")).schema)
                       .option("header", True).csv(regs), f"{batch_root}/store", 1)
    assert _counts(spark, f"{batch_root}/store") == counts


def test_registration_file_columns_are_taken_by_name(spark):
    from cohortflow.sources.tables import read_registrations_csv

    folder = tempfile.mkdtemp(prefix="cohortflow-csv-")
    rows = [("Retreat", "x", "10/5/2015", "12.0", "10/3/2015")]
    spark.createDataFrame(rows, "event string, note string, end_date string, person string, start_date string") \
        .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/regs")
    r = read_registrations_csv(spark, f"{folder}/regs", id_column="person").first()
    assert (r.member_id, r.event, r.start_date, r.end_date) == (12.0, "Retreat", "10/3/2015", "10/5/2015")


def test_completed_only_keeps_events_whose_post_window_ended(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-job-")
    store, regs = f"{root}/store", f"{root}/registrations"
    _store(spark, store)
    _csv(spark, regs)
    full = job.run(spark, regs, store, f"{root}/c", type_id=1, run_date=dt.date(2030, 1, 1), rules=FIXTURE_RULES)
    schema = spark.read.parquet(full).schema
    late = job.run(spark, regs, store, f"{root}/b", type_id=1, run_date=dt.date(2030, 1, 1),
                   rules=FIXTURE_RULES, completed_only=True)
    assert spark.read.parquet(late).count() == spark.read.parquet(full).count() > 0
    early = job.run(spark, regs, store, f"{root}/a", type_id=1, run_date=dt.date(1990, 1, 1),
                    rules=FIXTURE_RULES, completed_only=True)
    # an empty partitioned result has no data files: read it with the dataset schema
    assert spark.read.schema(schema).parquet(early).count() == 0


def test_cli_help():
    import subprocess
    import sys

    from conftest import ROOT

    out = subprocess.run([sys.executable, "-m", "cohortflow.plans.job", "--help"], cwd=ROOT, capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 0 and "--registrations" in out.stdout and "--completed-only" in out.stdout


def test_stream_of_two_files_equals_two_batches(spark):
    """Files arriving in separate micro-batches (an event's attendees split over
    both) give the same store as registering the two files one after the other.
    (One combined batch can attach a few more attendees: a registration joins every
    event stored with its name and start date at that time, Q15.)"""
    root = tempfile.mkdtemp(prefix="cohortflow-stream2-")
    raw = fx.fixture_registrations_raw(spark, SF001)
    first = raw.where(F.col("member_id") % 2 == 0)
    second = raw.where((F.col("member_id") % 2 != 0) | F.col("member_id").isNull())
    first.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/in")
    second.coalesce(1).write.mode("append").option("header", True).csv(f"{root}/in")
    _store(spark, f"{root}/s1")
    q = start_registration_ingest(spark, f"{root}/in", f"{root}/s1", type_id=1,
                                  checkpoint_location=f"{root}/ckpt", max_files_per_trigger=1)
    q.awaitTermination(300)
    folder = f"{root}/in"
    files = sorted((p for p in os.listdir(folder) if p.endswith(".csv")), key=lambda p: os.path.getmtime(f"{folder}/{p}"))
    assert len(files) == 2
    _store(spark, f"{root}/s2")
    for name in files:  # the stream takes files in modification order, as written above
        part = spark.read.option("header", True).csv(f"{root}/in/{name}")
        job.register_batch(spark, job_registration_columns(part), f"{root}/s2", 1)
    assert _counts(spark, f"{root}/s1") == _counts(spark, f"{root}/s2")
    ids = sorted(r.id for r in spark.read.parquet(sinks.table_path(f"{root}/s1", "program_event")).collect())
    assert ids == list(range(1, len(ids) + 1))


def test_job_checkpoints_into_the_sessions_checkpoint_dir(spark):
    from cohortflow.session import checkpoint_dir

    folder = checkpoint_dir(spark)
    local = folder.removeprefix("file:")

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(local) for f in fs}

    before = files()
    root = tempfile.mkdtemp(prefix="cohortflow-job-")
    _store(spark, f"{root}/store")
    _csv(spark, f"{root}/registrations")
    job.run(spark, f"{root}/registrations", f"{root}/store", f"{root}/out", type_id=1, run_date=RUN_DATE,
            rules=FIXTURE_RULES)
    assert files() - before  # parsed rows, event dimension and cohort were written under spark.checkpoint.dir


def _two_headers(spark, folder):
    """Two files with the same columns in another order."""
    a = [(1.0, "Retreat", "10/3/2015", "10/5/2015")]
    spark.createDataFrame(a, "member_id double, event string, start_date string, end_date string") \
        .coalesce(1).write.mode("overwrite").option("header", True).csv(folder)
    b = [("10/5/2015", "x", "10/3/2015", 2.0, "Retreat")]
    spark.createDataFrame(b, "end_date string, note string, start_date string, member_id double, event string") \
        .coalesce(1).write.mode("append").option("header", True).csv(folder)


def test_columns_by_name_in_every_file(spark):
    import pytest
    from pyspark.errors import PySparkException
    from cohortflow.sources.tables import read_registrations_csv
    from cohortflow.streaming.registrations import start_registration_ingest as start

    root = tempfile.mkdtemp(prefix="cohortflow-csv-")
    _two_headers(spark, f"{root}/in")
    rows = read_registrations_csv(spark, f"{root}/in").collect()
    assert sorted((r.member_id, r.event, r.start_date, r.end_date) for r in rows) == [
        (1.0, "Retreat", "10/3/2015", "10/5/2015"), (2.0, "Retreat", "10/3/2015", "10/5/2015")]
    # a stream has one schema: a file with another header stops it instead of being misread
    _store(spark, f"{root}/store")
    with pytest.raises(PySparkException):
        start(spark, f"{root}/in", f"{root}/store", type_id=1, checkpoint_location=f"{root}/ckpt").awaitTermination(300)


def test_empty_registration_folder(spark):
    from cohortflow.sources.tables import read_registrations_csv
    from cohortflow.streaming.registrations import registration_stream

    root = tempfile.mkdtemp(prefix="cohortflow-csv-")
    assert read_registrations_csv(spark, root).count() == 0
    assert registration_stream(spark, root, id_column="person").columns == ["member_id", "event", "start_date", "end_date"]


def test_stream_rejects_equal_batch_rejects(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-stream3-")
    _store(spark, f"{root}/s1")
    _store(spark, f"{root}/s2")
    _csv(spark, f"{root}/in")
    for _ in range(2):  # the second start finds nothing new
        start_registration_ingest(spark, f"{root}/in", f"{root}/s1", type_id=1, checkpoint_location=f"{root}/ckpt").awaitTermination(300)
    raw = job.read_registrations_csv(spark, f"{root}/in")
    want = job.register_batch(spark, raw, f"{root}/s2", 1).rejects
    got = spark.read.parquet(f"{root}/s1/registration_rejects").drop("epoch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0


def test_other_failures_are_raised(spark):
    import pytest

    root = tempfile.mkdtemp(prefix="cohortflow-store-")
    assert sinks.read_table_if_exists(spark, root, "members") is None
    with pytest.raises(Exception, match="no-such-scheme"):
        sinks.read_table_if_exists(spark, "no-such-scheme*?[", "members")


def _good(spark, rows):
    return spark.createDataFrame([(u, e, dt.date(2015, 10, 3), dt.date(2015, 10, 5)) for u, e in rows], "user_id long, event string, start_date date, end_date date")


def _stored(spark, base):
    return tuple(
        sorted(tuple(r)[:2] for r in df.collect()) if (df := sinks.read_table_if_exists(spark, base, name)) is not None else []
        for name in sinks.VERSIONED
    )


def test_a_run_that_dies_between_both_writes_shows_nothing(spark, monkeypatch):
    import pytest

    base = tempfile.mkdtemp(prefix="cohortflow-store-")
    job.append_batch(spark, _good(spark, [(1, "Camp")]), base, 1)
    before = _stored(spark, base)
    assert before == ([(1, "Camp")], [(1, 1)])

    def dies(*_):
        raise KeyboardInterrupt  # nothing is cleaned up after it

    monkeypatch.setattr(job.reg, "new_event_attendees", dies)
    with pytest.raises(KeyboardInterrupt):
        job.append_batch(spark, _good(spark, [(1, "Camp"), (2, "Retreat")]), base, 1)
    assert len(os.listdir(sinks.table_path(base, "program_event"))) == 2  # its events were written
    assert _stored(spark, base) == before
    monkeypatch.undo()
    job.append_batch(spark, _good(spark, [(1, "Camp"), (2, "Retreat")]), base, 1)
    assert _stored(spark, base) == ([(1, "Camp"), (2, "Retreat")], [(1, 1), (2, 2)])


def test_two_runs_at_once(spark, monkeypatch):
    """The run that publishes second registers again: no id is issued twice, nothing is lost."""
    base = tempfile.mkdtemp(prefix="cohortflow-store-")
    publish, others = sinks.publish, [[(2, "Retreat")], [(3, "Gala")]]

    def late(*args):
        if others:
            rows = others.pop()
            monkeypatch.setattr(sinks, "publish", publish)
            job.append_batch(spark, _good(spark, rows), base, 1)
            monkeypatch.setattr(sinks, "publish", late)
        return publish(*args)

    monkeypatch.setattr(sinks, "publish", late)
    raw = spark.createDataFrame([(1.0, "Camp", "10/3/2015", "10/5/2015")], "member_id double, event string, start_date string, end_date string")
    job.register_batch(spark, raw, base, 1)
    assert _stored(spark, base) == ([(1, "Gala"), (2, "Retreat"), (3, "Camp")], [(1, 3), (2, 2), (3, 1)])
    assert sinks.store_version(spark, base).number == 3
    folders = [f for f in os.listdir(sinks.table_path(base, "program_event")) if f.startswith("batch=")]
    assert len(folders) == 3  # the parts of the attempts that came too late are gone
    # Nothing new: no version, no part.
    job.register_batch(spark, raw, base, 1)
    assert sinks.store_version(spark, base).number == 3


def test_a_store_without_versions_is_taken_over(spark):
    base = tempfile.mkdtemp(prefix="cohortflow-store-")
    rows = [(7, "Camp", 1, dt.date(2015, 10, 3), dt.date(2015, 10, 5))]
    spark.createDataFrame(rows, NATIVE_TABLES["program_event"]).write.parquet(sinks.table_path(base, "program_event"))
    assert _stored(spark, base) == ([(7, "Camp")], [])
    job.append_batch(spark, _good(spark, [(1, "Camp"), (2, "Retreat")]), base, 1)
    assert _stored(spark, base) == ([(7, "Camp"), (8, "Retreat")], [(7, 1), (8, 2)])


def test_dataset_years_are_sized_and_replaced(spark):
    out = tempfile.mkdtemp(prefix="cohortflow-out-")
    rows = spark.range(3000).selectExpr("id", "CAST(2015 + id % 3 AS INT) AS FY").repartition(40)
    path = sinks.write_dataset(rows, out, RUN_DATE)
    files = [f for f in spark.read.parquet(path).inputFiles()]
    assert len(files) == 3  # not one per task and year
    sinks.write_dataset(spark.sql("SELECT -1L AS id, 2016 AS FY"), out, RUN_DATE)
    back = {r.FY: r["count"] for r in spark.read.parquet(path).groupBy("FY").count().collect()}
    assert back == {2015: 1000, 2016: 1, 2017: 1000}


def test_screen_without_a_members_table(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-store-")
    _csv(spark, f"{root}/in")
    raw = job.read_registrations_csv(spark, f"{root}/in")
    batch = job.register_batch(spark, raw, f"{root}/store", 1, None, screen=True)
    assert batch.summary.first().screened_rows > 0


def test_catalog_tables(spark):
    from cohortflow.sources.tables import read_catalog_tables

    inputs = fx.fixture_inputs(spark, SF001)
    spark.sql("CREATE DATABASE IF NOT EXISTS cohort_store")
    try:
        for name in NATIVE_TABLES:
            path = tempfile.mkdtemp(prefix="cohortflow-table-") + "/t"
            getattr(inputs, name).write.option("path", path).mode("overwrite").saveAsTable(f"cohort_store.{name}")
        back = read_catalog_tables(spark, "cohort_store")
        assert back.attendance.count() == inputs.attendance.count()
    finally:
        spark.sql("DROP DATABASE cohort_store CASCADE")
