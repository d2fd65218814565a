"""Mentorship graph metrics: first dates, reach, and the second-generation flag (A3, A7, UDF2).

Mentorships are interval-valued edges: `parent_user_id` mentors `user_id`
over [start_date, end_date], null end = still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validity import open_end
from .per_member import MemberFacts


def edges(mentorships: DataFrame) -> DataFrame:
    return mentorships.select("user_id", "parent_user_id", "start_date", "end_date")


def as_mentee(mentorships: DataFrame) -> MemberFacts:
    """first_became_disciple (UDF2, inferred: first mentorship start as mentee) and
    d1_end (latest end of an own mentorship, open = far future; used by the
    second-generation flag)."""
    rows = mentorships.select(
        "user_id", F.col("start_date").alias("first_became_disciple"), open_end(F.col("end_date")).alias("d1_end")
    )
    return MemberFacts(rows, (F.min("first_became_disciple").alias("first_became_disciple"), F.max("d1_end").alias("d1_end")))


def as_mentor(mentorships: DataFrame) -> MemberFacts:
    """first_became_dm (A3: first start as mentor, no as-of test) and is_mentor
    (the member has mentee rows, so counts are 0 rather than null)."""
    rows = mentorships.select(
        F.col("parent_user_id").alias("user_id"), F.col("start_date").alias("first_became_dm"), F.lit(1).alias("is_mentor")
    )
    return MemberFacts(rows, (F.min("first_became_dm").alias("first_became_dm"), F.max("is_mentor").alias("is_mentor")))


def mentorship_pairs(mentorships: DataFrame) -> DataFrame:
    """One row per (mentor, mentee) with the latest end over their edges (open = far future).

    "Some edge alive at t" (F12) is then `pair_end >= t`. The mentee may be null.
    Output: parent_user_id, user_id, pair_end.
    """
    return (
        edges(mentorships)
        .where(F.col("parent_user_id").isNotNull())
        .groupBy("parent_user_id", "user_id")
        .agg(F.max(open_end(F.col("end_date"))).alias("pair_end"))
    )


def second_generation_reach(mentorships: DataFrame) -> DataFrame:
    """A7 without the two-hop join: per mentor X, two dates that decide the flag at any t.

    The reference lists (D1 = X's own edge, D2 = X's mentee edge, D3 = that
    mentee's mentee edge), keeps rows whose three edges are alive at t (a
    missing D2 or D3 counts as alive) and flags 1 when D3 has a mentee. So a
    mentee Y of X, with pair_end(X,Y) >= t, gives 1 when Y has a live edge to
    a named mentee, and 0 when Y has no edge at all or a live edge with a null
    mentee. With reach1(Y) / reach0(Y) = latest end of Y's edges with / without
    a mentee:
      m1(X) = max over Y of least(pair_end, reach1(Y))                  -> 1 iff m1 >= t
      m0(X) = max over Y of pair_end if Y mentors no one,
              else least(pair_end, reach0(Y))                            -> 0 iff m0 >= t
    One row per pair; no edge is multiplied.
    Output: user_id (= X), m1, m0.
    """
    pairs = mentorship_pairs(mentorships)
    named = F.col("user_id").isNotNull()
    reach = pairs.groupBy(F.col("parent_user_id").alias("user_id")).agg(
        F.max(F.when(named, F.col("pair_end"))).alias("reach1"),
        F.max(F.when(~named, F.col("pair_end"))).alias("reach0"),
        F.lit(1).alias("has_d3"),
    )
    j = pairs.join(reach, "user_id", "left")
    pair_end = F.col("pair_end")
    return j.select(
        F.col("parent_user_id").alias("user_id"),
        F.when(F.col("reach1").isNotNull(), F.least(pair_end, F.col("reach1"))).alias("m1"),
        F.when(F.col("has_d3").isNull(), pair_end)
        .when(F.col("reach0").isNotNull(), F.least(pair_end, F.col("reach0")))
        .alias("m0"),
    )


def second_generation_at(t: Column, d1_end: Column, is_mentor: Column, m1: Column, m0: Column) -> Column:
    """The flag at t (Q19 kept): null unless the member's own mentorship is alive at t;
    0 when the member mentors no one; 1 when a live mentee has a live mentee of their
    own; 0 when a live mentee mentors no one; else null (all mentee lines ended).
    The reference picks any row of the group; the largest flag is taken (Q5)."""
    return (
        F.when(d1_end.isNull() | (d1_end < t), F.lit(None))
        .when(is_mentor.isNull(), F.lit(0))
        .when(m1 >= t, F.lit(1))
        .when(m0 >= t, F.lit(0))
        .cast("int")
    )


def second_generation(mentorships: DataFrame) -> MemberFacts:
    """m1, m0 of `second_generation_reach` as per-member facts."""
    return MemberFacts(second_generation_reach(mentorships), (F.max("m1").alias("m1"), F.max("m0").alias("m0")))
