"""Registration: parsing, events, attendees and idempotent appends."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from builders import D
from cohortflow.functions.dates import parse_date_text
from cohortflow.operators import registration as reg
from cohortflow.sources.schemas import PROGRAM_EVENT, REGISTRATIONS_CSV
from cohortflow.sources.tables import read_registrations_csv

RAW = [
    (1.0, "Retreat", "10/3/2015", "10/5/2015"),
    (2.0, "Retreat", "2015-10-03", "2015-10-05"),  # C16: same event written the other way
    (3.0, "Camp", "13/1/2015", "14/1/2015"),  # C17: day first when the month cannot be
    (4.0, "Camp", "TBD", "14/1/2015"),  # C15: unreadable date
    (None, "Retreat", "10/3/2015", "10/5/2015"),  # no user id
    (5.0, "Gala CANCELLED", "1/2/2016", "1/2/2016"),
    (6.0, "Fête", "1/3/2016", "1/3/2016"),
    (7.0, "Retreat", "10/3/2015", None),  # Q14: no end date, still matches by (name, start)
]


def _raw(spark):
    return spark.createDataFrame(RAW, REGISTRATIONS_CSV)


def test_c15_c16_c17_parse_and_reject(spark):
    parsed = reg.parse_registrations(_raw(spark))
    rejected = reg.rejected(parsed).collect()
    assert [r.user_id for r in rejected] == [4]
    events = {(r.event, r.start_date, r.end_date) for r in reg.batch_events(reg.accepted(parsed)).collect()}
    assert ("Retreat", D(2015, 10, 3), D(2015, 10, 5)) in events
    assert ("Camp", D(2015, 1, 13), D(2015, 1, 14)) in events
    assert len([e for e in events if e[0] == "Retreat"]) == 1


def test_screen_drops_cancelled_odd_names_and_staff(spark):
    staff = spark.createDataFrame([(3,)], "id bigint")
    kept = reg.screen_registrations(_raw(spark), staff).collect()
    names = {r.event for r in kept}
    assert "Gala CANCELLED" not in names and "Fête" not in names
    assert 3.0 not in {r.member_id for r in kept}
    assert None in {r.member_id for r in kept}


def test_new_events_ids_continue_and_idempotent_append(spark):
    good = reg.accepted(reg.parse_registrations(_raw(spark)))
    batch = reg.batch_events(good)
    existing = spark.createDataFrame([(7, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 5))], PROGRAM_EVENT)
    new = reg.new_program_events(batch, existing, 3).collect()
    assert sorted((r.id, r.name) for r in new) == [(8, "Camp"), (9, "Fête"), (10, "Gala CANCELLED")]
    assert {r.type_id for r in new} == {3}
    store = existing.unionByName(reg.new_program_events(batch, existing, 3))
    # The same batch again adds no events and no attendees.
    assert reg.new_program_events(batch, store, 3).count() == 0
    attendees = reg.registration_attendees(good, store)
    assert reg.new_event_attendees(attendees, attendees).count() == 0


def test_c13_same_name_and_start_two_end_dates_attach_to_both(spark):
    events = spark.createDataFrame(
        [(1, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 5)), (2, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 6))],
        PROGRAM_EVENT,
    )
    good = reg.accepted(reg.parse_registrations(_raw(spark)))
    pairs = {(r.event_id, r.user_id) for r in reg.registration_attendees(good, events).collect()}
    assert {(1, 1), (2, 1), (1, 7), (2, 7)} <= pairs
    assert all(u is not None for _, u in pairs)


def test_summary_counts(spark):
    row = reg.registration_summary(reg.parsed_once(_raw(spark))).first().asDict()
    assert row == {
        "raw_rows": 8, "screened_rows": 0, "rejected_rows": 1, "malformed_rows": 0, "attendees_before": 7,
        "unique_events": 4, "attendees_after": 6, "batch_events": 4,
    }


def test_summary_against_a_store(spark):
    parsed = reg.parsed_once(_raw(spark), screen=True)
    stored = [(1, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 5)), (2, "Retreat", 1, D(2015, 10, 3), D(2015, 10, 9)), (3, "Camp", 1, D(2015, 1, 13), D(2015, 1, 14))]
    row = reg.registration_summary(parsed, spark.createDataFrame(stored, PROGRAM_EVENT)).first()
    # three people at Retreat attach to both of its stored end dates (Q15), one is at Camp; two names are screened out
    assert (row.screened_rows, row.raw_rows, row.attendees_after, row.batch_events, row.unique_events) == (2, 6, 7, 2, 2)


@pytest.mark.parametrize(
    "text,want",
    [
        ("10/3/2015", D(2015, 10, 3)), ("13/1/2015", D(2015, 1, 13)), ("10-3-2015", D(2015, 10, 3)), ("10/3/15", D(2015, 10, 3)),
        ("10/3/95", D(1995, 10, 3)), ("13-1-15", D(2015, 1, 13)), ("2015-10-03", D(2015, 10, 3)), ("2015-1-3", D(2015, 1, 3)),
        ("10/3/2015 0:00", D(2015, 10, 3)), ("2015-10-03 00:00:00", D(2015, 10, 3)), ("2015-10-03T00:00:00", D(2015, 10, 3)),
        ("2015-10-03 23:59:59.123", D(2015, 10, 3)), ("Oct 3, 2015", D(2015, 10, 3)), ("october 3, 2015", D(2015, 10, 3)),
        ("3 Oct 2015", D(2015, 10, 3)), ("3 OCTOBER 2015", D(2015, 10, 3)), ("  10/3/2015 ", D(2015, 10, 3)), ("TBD", None),
        ("10/3/2015 12:00:00 AM", D(2015, 10, 3)), ("2015/10/03", D(2015, 10, 3)), ("3-Oct-15", D(2015, 10, 3)), ("3-Oct-2015", D(2015, 10, 3)),
        ("October 3rd, 2015", D(2015, 10, 3)), ("Oct 3 2015", D(2015, 10, 3)), ("2015-10-03T00:00:00Z", D(2015, 10, 3)), ("20151003", D(2015, 10, 3)),
        ("10.3.2015", D(2015, 10, 3)), ("Sat Oct 3 2015", D(2015, 10, 3)), ("Sept 3, 2015", D(2015, 9, 3)), ("Saturday, October 3, 2015", D(2015, 10, 3)),
        ("2015-10-03 00:00:00+02:00", D(2015, 10, 3)), ("10/3/2015 1:05 p.m.", D(2015, 10, 3)), ("1st Dec. 2015", D(2015, 12, 1)), ("20151303", None),
        ("10/3-2015", None), ("2/30/2015", None), ("14/13/2015", None), ("Foo 3, 2015", None), ("10/3/215", None), ("", None), (None, None),
    ],
)
def test_date_forms(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(parse_date_text(F.col("t")).alias("d")).first()
    assert row.d == want


def test_dates_are_parsed_once(spark):
    """The summary reads the written rows: no parse expression is left in its plan."""
    plan = reg.registration_summary(reg.parsed_once(_raw(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan and "rlike" not in plan.lower()


MALFORMED_LINES = [
    "2,Retreat", "3,Retreat,10/3/2015,10/5/2015,extra", '4,"Retreat,10/3/2015,10/5/2015', '5,"Retreat"x,10/3/2015,10/5/2015', "only",
]


def test_malformed_lines_are_rejected_by_their_text(spark, tmp_path):
    good = ['1,"Re ""x"", treat","Oct 3, 2015",10/5/2015', "6,,,", "7,Camp,TBD,", '8,Ret"reat,10/3/2015,10/5/2015']
    head = "member_id,event,start_date,end_date"
    (tmp_path / "a.csv").write_text("\n".join([head, *good, "", *MALFORMED_LINES]) + "\n")
    (tmp_path / "b.csv").write_text("end_date,note,event,member_id,start_date\n10/5/2015,x,Camp,9,10/3/2015\n10/5/2015,x,Camp\n")
    (tmp_path / "c.csv").write_text("")
    parsed = reg.parsed_once(read_registrations_csv(spark, str(tmp_path)))
    assert (parsed.raw_rows, parsed.rejected_rows, parsed.malformed_rows) == (11, 7, 6)
    out = [(r.user_id, r.event, r.start_date, r.malformed) for r in reg.rejected(parsed.rows).collect()]
    assert sorted(out, key=str) == sorted([(7, "Camp", "TBD", None), *((None, None, None, line) for line in [*MALFORMED_LINES, "10/5/2015,x,Camp"])], key=str)
    kept = {(r.user_id, r.event, r.start_date) for r in reg.accepted(parsed.rows).collect()}
    assert kept == {(1, 'Re "x", treat', D(2015, 10, 3)), (6, None, None), (8, 'Ret"reat', D(2015, 10, 3)), (9, "Camp", D(2015, 10, 3))}


def test_compressed_and_empty_sources(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"member_id,event,start_date,end_date\n1,Camp,10/3/2015,\n2,Camp\n"))
    parsed = reg.parsed_once(read_registrations_csv(spark, str(tmp_path)))
    assert (parsed.raw_rows, parsed.malformed_rows) == (2, 1)
    empty = tmp_path / "none"
    empty.mkdir()
    assert reg.parsed_once(read_registrations_csv(spark, str(empty))).raw_rows == 0
