"""As-of metrics: one sorted sweep serves every date-dependent metric at every probe date.

Four sources give intervals of (member, kind, other):

* MENTORED  (kind 0): the member is the mentee; test F10 (half-open)  -> mentored flag
* MENTEE    (kind 1): the member is the mentor; test F11 (closed)     -> active mentees
* CONTACT   (kind 2): contact chart rows the member owns; F11         -> count, latest start
* CHAIN     (kind 3): (mentor, mentee) pairs joined with the mentee's live-study
  intervals: the pair must be alive at t (F12 on its latest edge end) and the
  study schedule valid at t (F11), so the interval ends with the earlier of both
                                                                      -> leaders in chain

Overlapping intervals of one (member, kind, other) are merged, so at any date at
most one of them holds, and the number of others is a number of intervals. Each
interval is +1 on its first day and -1 on the first day it does not hold any
more. The changes are added up per (member, day), and one running sum per member
over changes and probes, sorted by day, gives every count: the cost is intervals
+ probes, no interval is tested against a probe, and what a sort holds of a
hot member is a row per day, not its intervals.

The latest start among the active contact rows is no sum. It has its own path:
rows of one (owner, start) are one row with the latest end, and these, at most
one per day and member, are joined with the probes by validity; the probes
take what they found along into the sweep.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.validity import OPEN_END, open_end
from . import mentorship as ms

MENTORED, MENTEE, CONTACT, CHAIN = 0, 1, 2, 3
ALL_KINDS = (MENTORED, MENTEE, CONTACT, CHAIN)

# The count that a kind's changes add to.
COUNTS = {MENTORED: "mentors", MENTEE: "mentees", CONTACT: "contacts", CHAIN: "chain"}


def merged_intervals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Unions of overlapping or touching [start_date, end_date] per key (null end =
    open): valid on exactly the same days under a closed test, and under a
    half-open one. Rows without a start, or with an end before it, are never valid
    and go. Output: keys, start_date, end_date."""
    rows = rows.where(F.col("start_date").isNotNull()).select(*keys, "start_date", open_end(F.col("end_date")).alias("end_date"))
    rows = rows.where(F.col("end_date") >= F.col("start_date"))
    ordered = Window.partitionBy(*keys).orderBy("start_date", "end_date")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.max("end_date").over(earlier))
    opens = F.coalesce(F.col("start_date") > F.col("before"), F.lit(True))
    opened = F.max(F.when(opens, F.col("start_date")))
    rows = rows.select(
        "*",
        opened.over(earlier).alias("previous"),
        opened.over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("current"),
        F.lead("start_date").over(ordered).isNull().alias("last"),
    )
    # A row that opens a union ends the one before it; the last row ends its own.
    union = lambda start, end: F.struct(F.col(start).alias("start_date"), end.alias("end_date"))
    ended = F.array(
        F.when(F.col("start_date") > F.col("before"), union("previous", F.col("before"))),
        F.when(F.col("last"), union("current", F.greatest("before", "end_date"))),
    )
    out = rows.select(*keys, F.explode(F.filter(ended, lambda r: r.isNotNull())).alias("r")).select(*keys, "r.*")
    closed = F.when(F.col("end_date") < F.lit(OPEN_END).cast("date"), F.col("end_date"))
    return out.select(*keys, "start_date", closed.alias("end_date"))


def interval_rows(
    mentorships: DataFrame,
    contact_chart: DataFrame,
    kinds: tuple[int, ...] = ALL_KINDS,
    leaders: DataFrame | None = None,
    span: tuple[Column, Column] | None = None,
) -> DataFrame:
    """The merged intervals of the requested kinds: user_id, kind, other_id,
    start_date, end_date (null: open).

    CHAIN needs `leaders` (leader_id, start_date, end_date). With `span`
    (first, last as-of date), intervals that cannot hold at any date in it are
    left out: ended before it, or starting after it.
    """
    stacked = []
    if MENTORED in kinds:
        stacked.append(_stacked(mentorships, MENTORED, "user_id", "parent_user_id"))
    if MENTEE in kinds:
        stacked.append(_stacked(mentorships, MENTEE, "parent_user_id", "user_id"))
    if CONTACT in kinds:
        stacked.append(_stacked(contact_chart, CONTACT, "chart_owner_id", "chart_member_id"))
    parts = []
    if stacked:
        rows = reduce(DataFrame.unionByName, stacked).where(F.col("user_id").isNotNull())
        # Only the mentored flag asks whether there is any interval; the others count named members.
        rows = rows.where((F.col("kind") == MENTORED) | F.col("other_id").isNotNull())
        parts.append(merged_intervals(within(rows, span), ["user_id", "kind", "other_id"]))
    if CHAIN in kinds:
        if leaders is None:
            raise ValueError("CHAIN rows need the leader intervals")
        pairs = ms.mentorship_pairs(mentorships)
        led = merged_intervals(within(leaders, span), ["leader_id"])
        # A pair that ended before the study began: the interval is empty, its two changes fall on one day.
        end = F.greatest(F.least(open_end(led.end_date), pairs.pair_end), F.date_sub(led.start_date, 1))
        parts.append(
            pairs.join(led, pairs.user_id == led.leader_id)
            .select(
                pairs.parent_user_id.alias("user_id"), F.lit(CHAIN).alias("kind"), pairs.user_id.alias("other_id"), led.start_date,
                F.when(end < F.lit(OPEN_END).cast("date"), end).alias("end_date"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def within(rows: DataFrame, span: tuple[Column, Column] | None) -> DataFrame:
    """Intervals that may hold at some date of the span; all of them without one."""
    if span is None:
        return rows
    first, last = span
    return rows.where(F.coalesce(F.col("end_date") >= first, F.lit(True)) & F.coalesce(F.col("start_date") <= last, F.lit(True)))


def contact_starts(contact_chart: DataFrame, span: tuple[Column, Column] | None = None) -> DataFrame:
    """The contact chart for the latest active start: per owner and start date the
    latest end (open: far future). Output: owner_id, start_date, last_end."""
    rows = within(contact_chart, span).where(F.col("chart_owner_id").isNotNull() & F.col("start_date").isNotNull())
    return rows.groupBy(F.col("chart_owner_id").alias("owner_id"), "start_date").agg(F.max(open_end(F.col("end_date"))).alias("last_end"))


def _stacked(rows: DataFrame, kind: int, user: str, other: str) -> DataFrame:
    return rows.select(F.col(user).alias("user_id"), F.lit(kind).alias("kind"), F.col(other).alias("other_id"), "start_date", "end_date")


def changes(intervals: DataFrame) -> DataFrame:
    """How many more or fewer intervals of each kind hold from a day on: one row per
    (user_id, _t) with a column per kind. A closed interval holds on its last day, a
    half-open one (MENTORED) does not."""
    ends = F.when(F.col("kind") == MENTORED, F.col("end_date")).otherwise(F.date_add("end_date", 1))
    both = F.array(F.struct(F.col("start_date").alias("_t"), F.lit(1).alias("d")), F.struct(ends.alias("_t"), F.lit(-1).alias("d")))
    rows = intervals.select("user_id", "kind", F.explode(both).alias("r")).where(F.col("r._t").isNotNull())
    return rows.groupBy("user_id", F.col("r._t").alias("_t")).agg(
        *[F.sum(F.when(F.col("kind") == kind, F.col("r.d"))).alias(name) for kind, name in COUNTS.items()]
    )


def as_of_metrics(
    probes: DataFrame,
    key_cols: list[str],
    times: dict[str, str],
    intervals: DataFrame,
    contacts: DataFrame | None = None,
) -> DataFrame:
    """Date-dependent metrics for every probe row at each date column in `times`.

    `probes` has `key_cols` (which include user_id and are unique per row) and
    the date columns named in `times` (suffix -> column). Returns one row per
    probe with, per suffix: mentored_<sfx> (0/1), mentees_<sfx>,
    contacts_<sfx>, chain_<sfx> (0 where none holds), and, where `contacts`
    (`contact_starts`) is given, contact_latest_<sfx> (null where no row is active).
    """
    return swept(probes, key_cols, times, changes(intervals), contacts)


def swept(probes: DataFrame, key_cols: list[str], times: dict[str, str], changed: DataFrame, contacts: DataFrame | None = None) -> DataFrame:
    """`as_of_metrics` over changes that are made already."""
    asked = probes.select(*key_cols, *[F.col(c).alias(f"_t_{s}") for s, c in times.items()])
    if contacts is not None:
        active = {s: (F.col("start_date") <= F.col(f"_t_{s}")) & (F.col("last_end") >= F.col(f"_t_{s}")) for s in times}
        met = asked.join(contacts, (F.col("user_id") == F.col("owner_id")) & reduce(Column.__or__, active.values()), "left")
        asked = met.groupBy(*asked.columns).agg(*[F.max(F.when(a, F.col("start_date"))).alias(f"contact_latest_{s}") for s, a in active.items()])
    found = [c for c in asked.columns if c.startswith("contact_latest_")]
    names = list(COUNTS.values())
    # Changes and probes of a member come together once; a probe becomes a row per date there.
    rows = changed.unionByName(asked.withColumn("_probe", F.lit(True)), allowMissingColumns=True).repartition("user_id")
    dates = F.array(*[F.struct(F.lit(s).alias("_sfx"), F.col(f"_t_{s}").alias("_t")) for s in times])
    at = F.when(F.col("_probe"), dates).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("_sfx"), F.col("_t"))))
    others = [c for c in key_cols if c != "user_id"]
    rows = rows.select("user_id", *others, *names, *found, F.explode(at).alias("_at")).select("user_id", *others, *names, *found, "_at.*")
    upto = Window.partitionBy("user_id").orderBy("_t")  # a RANGE frame: changes of the probe's own day count
    rows = rows.select(*key_cols, "_sfx", *found, *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in names])
    at = lambda c, s: F.max(F.when(F.col("_sfx") == s, F.col(c)))
    aggs = [F.max(c).alias(c) for c in found]
    for s in times:
        aggs.append((at("mentors", s) > 0).cast("int").alias(f"mentored_{s}"))
        aggs += [at(c, s).cast("bigint").alias(f"{c}_{s}") for c in names[1:]]
    return rows.where(F.col("_sfx").isNotNull()).groupBy(*key_cols).agg(*aggs)
