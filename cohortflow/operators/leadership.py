"""Study leadership and outreach metrics (A5, the leader side of A8, J9/A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import outcome_label
from .per_member import MemberFacts


def led_studies(study_groups: DataFrame, study_schedules: DataFrame) -> MemberFacts:
    """A5 earliest_led_bs: first study start over every schedule of every group a
    member leads; neither `deleted` nor `is_latest` is tested, as in the reference."""
    g = study_groups.select(F.col("id").alias("study_id"), F.col("leader_id").alias("user_id"))
    s = study_schedules.select("study_id", F.col("study_start_date").alias("earliest_led_bs"))
    rows = g.join(s, "study_id").select("user_id", "earliest_led_bs")
    return MemberFacts(rows, (F.min("earliest_led_bs").alias("earliest_led_bs"),))


def leader_intervals(study_groups: DataFrame, study_schedules: DataFrame, members: DataFrame) -> DataFrame:
    """When each member leads a live study: latest schedules of groups not deleted.

    The leader must exist as a member (J13). Distinct intervals only.
    Output: leader_id, start_date, end_date.
    """
    g = study_groups.where(F.col("deleted") == 0).select(F.col("id").alias("study_id"), "leader_id")
    s = study_schedules.where(F.col("is_latest") == 1).select(
        "study_id", F.col("study_start_date").alias("start_date"), F.col("study_end_date").alias("end_date")
    )
    li = g.join(s, "study_id").select("leader_id", "start_date", "end_date")
    li = li.join(members.select(F.col("id").alias("leader_id")), "leader_id", "left_semi")
    return li.distinct()


def outcome(outreach_outcomes: DataFrame) -> MemberFacts:
    """J9 + A9 + X6: one outcome label per member. The reference takes any row of
    the group; the largest label is taken here ('1' over '0' over null, Q5)."""
    rows = outreach_outcomes.select("user_id", outcome_label(F.col("outcome")).alias("outcome"))
    return MemberFacts(rows, (F.max("outcome").alias("outcome"),))
