"""Adapters from the driver's generated tables to the native input tables.

The reference ships no data. These adapters map the driver tables onto the
native schemas (mapping documented in FIXTURES.md, section B) so every query
reads the given tables and its work grows with them. Every row of a driver
table becomes a row of the native table; absence is seeded as null ids by
modulo rules, never by dropping rows.
"""

from __future__ import annotations

from dataclasses import fields
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import EVENT_TYPE_NAMES
from ..operators import registration as reg
from .tables import CohortInputs


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def _month0(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def members(customer: DataFrame, events: DataFrame) -> DataFrame:
    last_login = events.groupBy("user_id").agg(F.max("ts").alias("last_login"))
    c = customer
    return c.join(last_login, c.c_custkey == last_login.user_id, "left").select(
        c.c_custkey.alias("id"),
        c.c_name.alias("first_name"),
        c.c_mktsegment.alias("last_name"),
        _null_if(c.c_custkey % 23 == 0, 1 + c.c_custkey % 7).cast("int").alias("school_year_id"),
        c.c_nationkey.cast("bigint").alias("campus_id"),
        _null_if(c.c_custkey % 29 == 0, 1 + c.c_custkey % 8).cast("int").alias("user_role_type_id"),
        last_login.last_login,
    )


def org_units(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("int").alias("region_id"),
    )


def registrations(orders: DataFrame) -> DataFrame:
    """Registrations with typed dates: (user_id, event, start_date, end_date)."""
    k = F.col("o_orderkey")
    start = _month0(F.col("o_orderdate"))
    return orders.select(
        _null_if(k % 41 == 0, F.col("o_custkey")).cast("bigint").alias("user_id"),
        _null_if(k % 53 == 0, F.col("o_orderpriority")).alias("event"),
        start.alias("start_date"),
        _null_if(k % 37 == 0, F.date_add(start, 3)).alias("end_date"),
    )


def registrations_raw(orders: DataFrame) -> DataFrame:
    """Registrations as the CSV gives them: double user id, free-text dates, unscreened names."""
    return keyed_registrations(orders).drop("k")


def keyed_registrations(orders: DataFrame) -> DataFrame:
    """`registrations_raw` with the order key `k` that seeds it."""
    k = F.col("o_orderkey")
    start = _month0(F.col("o_orderdate"))
    end = F.date_add(start, 3)
    # One written form per remainder of the order key.
    forms = (
        "M/d/yyyy", "yyyy-MM-dd", "M/d/yy", "M-d-yyyy", "M/d/yyyy' 0:00'", "yyyy-MM-dd' 00:00:00'", "yyyy-MM-dd'T00:00:00'", "MMM d, yyyy", "d MMM yyyy",
        "M/d/yyyy' 12:00:00 AM'", "yyyy/MM/dd", "d-MMM-yy", "d-MMM-yyyy", "MMMM d'th', yyyy", "MMM d yyyy", "yyyy-MM-dd'T00:00:00Z'", "yyyyMMdd", "M.d.yyyy",
        "E MMM d yyyy",
    )

    def as_text(d: Column) -> Column:
        written = F.date_format(d, forms[0])
        for i, form in enumerate(forms[1:], start=1):
            written = F.when(k % len(forms) == i, F.date_format(d, form)).otherwise(written)
        return written

    prio = F.col("o_orderpriority")
    event = (
        F.when(k % 53 == 0, F.lit(None).cast("string"))
        .when(k % 61 == 0, F.concat(prio, F.lit(" CANCELLED")))
        .when(k % 67 == 0, F.concat(prio, F.lit(" été")))
        .otherwise(prio)
    )
    return orders.select(
        _null_if(k % 41 == 0, F.col("o_custkey")).cast("double").alias("member_id"),
        event.alias("event"),
        F.when(k % 71 == 0, F.lit("TBD")).otherwise(as_text(start)).alias("start_date"),
        _null_if(k % 37 == 0, as_text(end)).alias("end_date"),
        k.alias("k"),
    )


def write_damaged_registrations(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The registration file, written as CSV lines below `path`, every file with the
    header. Some lines lack values, have one too many, leave a quote open or go on
    behind a closing quote."""
    rows = keyed_registrations(driver_table(spark, sf_dir, "orders"))
    k, text = F.col("k") % 97, lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    quoted = lambda name: F.when(F.col(name).isNull(), F.lit("")).otherwise(F.concat(F.lit('"'), F.col(name), F.lit('"')))
    line = (
        F.when(k == 1, F.concat_ws(",", text("member_id"), text("event")))
        .when(k == 2, F.concat_ws(",", text("member_id"), text("event"), quoted("start_date"), quoted("end_date"), F.lit("more")))
        .when(k == 3, F.concat_ws(",", text("member_id"), F.concat(F.lit('"'), text("event")), text("start_date"), text("end_date")))
        .when(k == 4, F.concat_ws(",", text("member_id"), F.concat(F.lit('"'), text("event"), F.lit('"x')), text("start_date"), text("end_date")))
        .otherwise(F.concat_ws(",", text("member_id"), text("event"), quoted("start_date"), quoted("end_date")))
    )
    # One column, named like the header, written as it is.
    lines = rows.select(line.alias("member_id,event,start_date,end_date"))
    lines.write.options(header=True, sep="\x01", quote="", escapeQuotes=False).csv(path)


def fixture_type_id(name: Column) -> Column:
    """Event type of a fixture event: the digit that starts its priority name."""
    return F.substring(name, 1, 1).cast("int")


def program_event(registrations_typed: DataFrame) -> DataFrame:
    """The event table after registering every fixture event (S4 on an empty store). The
    numbering writes the events once; what reads them starts there."""
    return reg.new_program_events(reg.batch_events(registrations_typed), None, fixture_type_id)


def program_event_type(events: DataFrame) -> DataFrame:
    """One type row per type id in `events` (a frame with `type_id`); names from the
    fixed list, else 'Type <id>'."""
    names = F.create_map(*[x for k, v in EVENT_TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    ids = events.select(F.col("type_id").alias("id")).where(F.col("id").isNotNull()).distinct()
    return ids.select(
        F.col("id").cast("int").alias("id"),
        F.coalesce(names[F.col("id")], F.concat(F.lit("Type "), F.col("id").cast("string"))).alias("name"),
    )


def _seldom_held(custkey: Column) -> Column:
    """Members whose sessions are all cancelled (and who attend few, see `attendance`)."""
    return custkey % 40 == 7


def sessions(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when((F.col("o_orderstatus") == "P") | _seldom_held(F.col("o_custkey")), F.lit(1)).cast("int").alias("cancel_reason_id"),
    )


def attendance(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    o = orders.select("o_orderkey", "o_custkey")
    key, cust = F.col("l_orderkey"), F.col("o_custkey")
    # Ids of every third order repeat over the member's other such orders, so on several days.
    repeated = F.when(key % 3 == 0, -cust * 10).otherwise(key * 10)
    absent = _seldom_held(cust) & (key % 8 != 0)
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        (repeated + F.col("l_linenumber")).cast("bigint").alias("id"),
        _null_if(absent, cust).alias("user_id"),
        F.col("l_orderkey").alias("session_id"),
        F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(F.lit(1)).cast("int").alias("attended"),
    )


def mentorships(orders: DataFrame) -> DataFrame:
    start, cust = F.col("o_orderdate").cast("date"), F.col("o_custkey")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        _null_if((cust % 4 == 1) | (F.col("o_orderkey") % 43 == 0), cust).alias("user_id"),
        _null_if((cust < 10) | (cust % 7 == 3), F.floor(cust / 10).cast("bigint")).alias("parent_user_id"),
        start.alias("start_date"),
        _null_if(F.col("o_orderstatus") == "O", F.date_add(start, 365)).alias("end_date"),
    )


def outreach_outcomes(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return orders.select(
        _null_if(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("user_id"),
        F.when(status == "F", F.lit(1)).when(status == "O", F.lit(0)).cast("int").alias("outcome"),
    )


def study_groups(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        _null_if(F.col("o_custkey") % 3 != 1, F.col("o_custkey")).alias("leader_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(1)).otherwise(F.lit(0)).cast("int").alias("deleted"),
    )


def study_schedules(lineitem: DataFrame) -> DataFrame:
    start = F.col("l_shipdate").cast("date")
    return lineitem.select(
        F.col("l_orderkey").alias("study_id"),
        start.alias("study_start_date"),
        _null_if(F.col("l_linestatus") == "O", F.date_add(start, 365)).alias("study_end_date"),
        F.when(F.col("l_returnflag") == "N", F.lit(0)).otherwise(F.lit(1)).cast("int").alias("is_latest"),
    )


def contact_chart(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_shipdate", "l_linestatus")
    o = orders.select("o_orderkey", "o_custkey")
    start = F.col("l_shipdate").cast("date")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _null_if(F.col("o_custkey") % 5 == 2, F.col("o_custkey")).alias("chart_owner_id"),
        _null_if(F.col("l_partkey") % 19 == 0, F.col("l_partkey")).alias("chart_member_id"),
        start.alias("start_date"),
        _null_if(F.col("l_linestatus") == "O", F.date_add(start, 365)).alias("end_date"),
    )


def fixture_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registrations(driver_table(spark, sf_dir, "orders"))


def fixture_registrations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registrations_raw(driver_table(spark, sf_dir, "orders"))


class FixtureInputs:
    """The native tables (as `CohortInputs`), each derived from the driver tables when
    it is first asked for: a unit that reads no event numbers none."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir

    def _driver(self, name: str) -> DataFrame:
        return driver_table(self._spark, self._sf_dir, name)

    def replace(self, **changes: DataFrame) -> CohortInputs:
        return CohortInputs(**{f.name: changes.get(f.name) or getattr(self, f.name) for f in fields(CohortInputs)})

    @cached_property
    def program_event(self) -> DataFrame:
        return program_event(registrations(self._driver("orders")))

    @cached_property
    def program_event_type(self) -> DataFrame:
        return program_event_type(self.program_event)

    @cached_property
    def event_attendees(self) -> DataFrame:
        return reg.registration_attendees(registrations(self._driver("orders")), self.program_event)

    @cached_property
    def members(self) -> DataFrame:
        return members(self._driver("customer"), self._driver("events"))

    @cached_property
    def org_units(self) -> DataFrame:
        return org_units(self._driver("nation"))

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions(self._driver("orders"))

    @cached_property
    def attendance(self) -> DataFrame:
        return attendance(self._driver("lineitem"), self._driver("orders"))

    @cached_property
    def mentorships(self) -> DataFrame:
        return mentorships(self._driver("orders"))

    @cached_property
    def outreach_outcomes(self) -> DataFrame:
        return outreach_outcomes(self._driver("orders"))

    @cached_property
    def study_groups(self) -> DataFrame:
        return study_groups(self._driver("orders"))

    @cached_property
    def study_schedules(self) -> DataFrame:
        return study_schedules(self._driver("lineitem"))

    @cached_property
    def contact_chart(self) -> DataFrame:
        return contact_chart(self._driver("lineitem"), self._driver("orders"))


def fixture_inputs(spark: SparkSession, sf_dir: str) -> FixtureInputs:
    """All native tables, derived lazily from the driver tables in `sf_dir`."""
    return FixtureInputs(spark, sf_dir)
