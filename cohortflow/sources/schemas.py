"""Explicit schemas of the native input tables (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

REGISTRATIONS_CSV = T.StructType(
    [
        T.StructField("member_id", T.DoubleType()),
        T.StructField("event", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
    ]
)

PROGRAM_EVENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("type_id", T.IntegerType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
    ]
)

PROGRAM_EVENT_TYPE = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])

EVENT_ATTENDEES = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])

MEMBERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("school_year_id", T.IntegerType()),
        T.StructField("campus_id", T.LongType()),
        T.StructField("user_role_type_id", T.IntegerType()),
        T.StructField("last_login", T.TimestampNTZType()),
    ]
)

ORG_UNITS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("region_id", T.IntegerType())]
)

SESSIONS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("date", T.DateType()), T.StructField("cancel_reason_id", T.IntegerType())]
)

ATTENDANCE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.LongType()),
        T.StructField("attended", T.IntegerType()),
    ]
)

MENTORSHIPS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("parent_user_id", T.LongType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
    ]
)

OUTREACH_OUTCOMES = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("outcome", T.IntegerType())])

STUDY_GROUPS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("leader_id", T.LongType()), T.StructField("deleted", T.IntegerType())]
)

STUDY_SCHEDULES = T.StructType(
    [
        T.StructField("study_id", T.LongType()),
        T.StructField("study_start_date", T.DateType()),
        T.StructField("study_end_date", T.DateType()),
        T.StructField("is_latest", T.IntegerType()),
    ]
)

CONTACT_CHART = T.StructType(
    [
        T.StructField("chart_owner_id", T.LongType()),
        T.StructField("chart_member_id", T.LongType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
    ]
)

# Table name -> schema, for the parquet/table readers and the sinks.
NATIVE_TABLES = {
    "program_event": PROGRAM_EVENT,
    "program_event_type": PROGRAM_EVENT_TYPE,
    "event_attendees": EVENT_ATTENDEES,
    "members": MEMBERS,
    "org_units": ORG_UNITS,
    "sessions": SESSIONS,
    "attendance": ATTENDANCE,
    "mentorships": MENTORSHIPS,
    "outreach_outcomes": OUTREACH_OUTCOMES,
    "study_groups": STUDY_GROUPS,
    "study_schedules": STUDY_SCHEDULES,
    "contact_chart": CONTACT_CHART,
}
