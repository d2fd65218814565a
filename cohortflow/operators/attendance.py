"""Study-session attendance before and after each event (A1, A2, UDF1, Q3).

The reference counts `count(distinct attendance.id)` per member over a date
window, with the session joined on id and date range. Here one pass over
attendance and sessions reduces the facts to per-(member, day) rows, so the
join with the cohort touches at most one row per member-day and kind:

* day rows ``(user, kind=attended, lo=day, hi=day, n)``: distinct attendance
  ids seen on that day;
* link rows ``(user, kind, lo=prev_day, hi=day, n=-1 per id)``: an id seen on
  several days would be counted once per day; each pair of consecutive days of
  one id that both fall in a window takes one back, so the window sum is an
  exact distinct count for any input (ids repeat in the fixture);
* cancelled rows ``(kind=2)``: raw attendance rows on cancelled sessions, for
  the pre-event drop rule (Q3);
* member rows ``(kind=3)``: all attendance rows of the member and the earliest
  attended day.

The facts are scanned and joined once, placed by (user, attended, id), and
windowed in that placement; the reduced rows are written once, and meet the
cohort in one shuffle by member, in tasks of `TASK_ROWS` rows.

Windows are then read off running sums: the rows of a member, sorted by day, are
added up, and a window's count of day rows is the sum at its last day less the
sum on the day before its first. Nothing tests a day against an event, so the
cost is facts + probes in one sort.

A link row is in a window when lo and hi both are, a condition in two
dimensions. It is taken apart on `lo`: a link row stands in one node of 2^k days
per level k, a window covers the days of `lo` by a few nodes of different
levels, and inside each node running sums over `hi` are read at the window's
last day. Links longer than the longest window can be in none and are left
out; only members that have links send probes to their nodes.

Behind the reduction a member has at most a row per day and kind, and a link row
per pair of days at most a longest window apart (each in a node per level),
however many rows it had, so no sort holds a hot member's facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

ABSENT, ATTENDED, CANCELLED, MEMBER = 0, 1, 2, 3
PRE, POST = 0, 1


def session_facts(attendance: DataFrame, sessions: DataFrame) -> DataFrame:
    """Attendance rows with their session's date and cancel state (left join on session id).

    A row whose session is missing keeps a null date: it never falls in a
    window, as with the reference's left join. Session ids are taken to be
    unique (primary key of the sessions table).
    Output: id, user_id, attended, date, cancelled.
    """
    a = attendance.where(F.col("user_id").isNotNull()).select("id", "user_id", "session_id", "attended")
    s = sessions.select(F.col("id").alias("session_id"), "date", "cancel_reason_id")
    return a.join(s, "session_id", "left").select(
        "id", "user_id", "attended", "date", F.col("cancel_reason_id").isNotNull().alias("cancelled")
    )


def window_facts(facts: DataFrame, span: tuple[Column, Column] | None = None, longest: Column | None = None) -> DataFrame:
    """The reduced fact table: (user_id, kind, lo, hi, n, first_day).

    The rows of one (user, attended, id) lie together, sorted by day: the first of
    a day gives its day and link row, every row its member and cancelled row,
    and one sum reduces them.

    `span` (first, last day) bounds every window of the batch: rows outside it
    can never be counted in a window, so only member rows come from them.
    `longest` is the length in days of the longest window (last day less first).
    """
    dated = F.col("date").isNotNull()
    held = dated & ~F.col("cancelled")
    inside = dated if span is None else dated & F.col("date").between(*span)
    counted = held & F.col("inside") & F.col("attended").isin(0, 1) & F.col("id").isNotNull()
    placed = facts.repartition("user_id", "attended", "id").withColumn("inside", inside).withColumn("counted", counted)
    before = F.lag("date").over(Window.partitionBy("user_id", "attended", "id", "counted").orderBy("date"))
    rows = placed.withColumn("before", before)
    new_day = F.col("counted") & (F.col("before").isNull() | (F.col("before") < F.col("date")))
    apart = F.datediff("date", "before")
    rows = rows.withColumn("link", apart.isNotNull() if longest is None else apart <= longest)
    one = F.lit(1)
    kinds = F.array(
        _row(F.lit(MEMBER), F.lit(None), F.lit(None), one, F.when(held & (F.col("attended") == 1), F.col("date"))),
        F.when(new_day, _row(F.col("attended"), F.col("date"), F.col("date"), one)),
        F.when(new_day & F.col("link"), _row(F.col("attended"), F.col("before"), F.col("date"), F.lit(-1))),
        F.when(F.col("cancelled") & F.col("inside"), _row(F.lit(CANCELLED), F.col("date"), F.col("date"), one)),
    )
    exploded = rows.select("user_id", F.explode(F.filter(kinds, lambda r: r.isNotNull())).alias("r"))
    return (
        exploded.select("user_id", "r.*")
        .groupBy("user_id", "kind", "lo", "hi")
        .agg(F.sum("n").cast("bigint").alias("n"), F.min("first_day").alias("first_day"))
    )


def facts_within(wfacts: DataFrame, span: tuple[Column, Column] | None) -> DataFrame:
    """What the windows of a batch can count of the facts of all days: member rows, and rows inside the span."""
    if span is None:
        return wfacts
    first, last = span
    return wfacts.where((F.col("kind") == MEMBER) | ((F.col("lo") >= first) & (F.col("hi") <= last)))


def _row(kind: Column, lo: Column, hi: Column, n: Column, first_day: Column | None = None) -> Column:
    first_day = F.lit(None) if first_day is None else first_day
    return F.struct(
        kind.cast("int").alias("kind"),
        lo.cast("date").alias("lo"),
        hi.cast("date").alias("hi"),
        n.cast("bigint").alias("n"),
        first_day.cast("date").alias("first_day"),
    )


def earliest_attendance(facts: DataFrame) -> DataFrame:
    """UDF1 (body not shipped; inferred): first held (not cancelled) session a
    member attended. Output: user_id, earliest_attendance."""
    held = F.col("date").isNotNull() & ~F.col("cancelled") & (F.col("attended") == 1)
    return facts.where(held).groupBy("user_id").agg(F.min("date").alias("earliest_attendance"))


# Levels of the nodes that link rows stand in: nodes of 1, 2, 4, ... 2^TOP days.
TOP = 8
# The node of day and member rows.
DAYS = -1


def _node(level: str, place: str) -> str:
    return f"shiftleft(CAST({level} AS BIGINT), 32) + {place} + {1 << 30}"


def _nodes_of(day: str) -> Column:
    """The nodes, one per level, that hold a day (days since 1970, as SQL)."""
    return F.expr(f"transform(sequence(0, {TOP}), k -> {_node('k', f'shiftright({day}, k)')})")


def _cover(first: str, end: str) -> Column:
    """The fewest nodes that hold the days first <= day < end, each day once."""
    low, high = lambda k: f"shiftright({first} + shiftleft(1, {k}) - 1, {k})", lambda k: f"shiftright({end}, {k})"
    sides = (
        f"CASE WHEN {low('k')} & 1 = 1 THEN {_node('k', low('k'))} END",
        f"CASE WHEN {high('k')} & 1 = 1 THEN {_node('k', high('k') + ' - 1')} END",
    )
    below = f"transform(sequence(0, {TOP - 1}), k -> CASE WHEN {low('k')} < {high('k')} THEN array({', '.join(sides)}) ELSE array() END)"
    top = f"CASE WHEN {low(TOP)} < {high(TOP)} THEN transform(sequence({low(TOP)}, {high(TOP)} - 1), p -> {_node(str(TOP), 'p')}) ELSE array() END"
    return F.expr(f"concat(array_compact(flatten({below})), {top})")


def _readings(first: str, last: str, window: int) -> Column:
    """Where the running sums are read for the window [first, last]: structs (node, t,
    window, sign). A window whose last day is before its first has none; only a
    member with links (column `linked`) reads the nodes."""
    at = f"named_struct('node', {{0}}, 't', {{1}}, 'window', {window}, 'sign', {{2}})"
    days = f"array({at.format(f'{DAYS}L', f'date_sub({first}, 1)', -1)}, {at.format(f'{DAYS}L', last, 1)})"
    nodes = F.transform(_cover(f"unix_date({first})", f"unix_date({last})"), lambda n: F.struct(
        n.alias("node"), F.col(last).alias("t"), F.lit(window).alias("window"), F.lit(1).alias("sign")
    ))
    held = F.when(F.col("linked"), F.concat(F.expr(days), nodes)).otherwise(F.expr(days))
    return F.when(F.col(first) <= F.col(last), held).otherwise(F.slice(F.expr(days), 1, 0))


# Facts and probes of one task: a member's facts stand in several nodes there, so a task holds a few times as many rows.
TASK_ROWS = 200_000


def attendance_windows(probes: DataFrame, wfacts: DataFrame, total: int | None = None) -> DataFrame:
    """Counts per cohort row for the pre window [before, start] and post window [end, after].

    `probes` holds event_id, user_id, before_date, start_date, end_date,
    after_date (one row per event and member). Every probe row comes out, with
    zeros when nothing matches (Q10). `total` is about the number of rows of both,
    which decides the number of tasks; without it the rows are written and counted.
    Output: event_id, user_id, attended_before, absent_before, attended_after,
    absent_after, cancelled_before, total_rows, earliest_attendance.
    """
    kind, n, link = F.col("kind"), F.col("n"), F.coalesce(F.col("lo") < F.col("hi"), F.lit(False))
    counted = {"att": ATTENDED, "abs": ABSENT, "can": CANCELLED, "total": MEMBER}
    asked = probes.select("event_id", "user_id", "before_date", "start_date", "end_date", "after_date", F.lit(True).alias("probe"))
    # A member's facts and probes come together once; all that follows is done where they are.
    rows = wfacts.unionByName(asked, allowMissingColumns=True)
    if total is None:
        rows = materialize(rows, "member_days")
        total = rows.count()
    rows = rows.repartition(max(1, -(-total // TASK_ROWS)), "user_id")
    rows = rows.withColumn("linked", F.max(link).over(Window.partitionBy("user_id")))

    days, no_day, no_int = F.lit(DAYS).cast("bigint"), F.lit(None).cast("date"), F.lit(None).cast("int")
    place = lambda node, t: F.struct(node.alias("node"), t.alias("t"), no_int.alias("window"), no_int.alias("sign"))
    nodes = F.when(link, _nodes_of("unix_date(lo)")).otherwise(F.array(days))
    readings = F.concat(_readings("before_date", "start_date", PRE), _readings("end_date", "after_date", POST))
    readings = F.when(F.size(readings) > 0, readings).otherwise(F.array(place(days, no_day)))
    at = F.when(F.col("probe"), readings).otherwise(F.transform(nodes, lambda node: place(node, F.col("hi"))))
    rows = rows.select("event_id", "user_id", "probe", "kind", "n", "first_day", F.explode(at).alias("r"))
    rows = rows.select("event_id", "user_id", "probe", "kind", "n", "first_day", "r.*")

    # Rows of one day come before the reading of that day: a RANGE frame takes in the day's peers.
    upto = Window.partitionBy("user_id", "node").orderBy("t")
    sums = rows.select(
        "event_id", "user_id", "node", "window", "sign", "probe",
        *[F.sum(F.when(kind == of, n)).over(upto).alias(name) for name, of in counted.items()], F.min("first_day").over(upto).alias("first_day"),
    ).where("probe")

    def total_of(name: str, window: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("window") == window, F.col(name) * F.col("sign"))), F.lit(0)).cast("bigint")

    of_member = F.col("node") == DAYS
    return sums.groupBy("event_id", "user_id").agg(
        total_of("att", PRE).alias("attended_before"),
        total_of("abs", PRE).alias("absent_before"),
        total_of("att", POST).alias("attended_after"),
        total_of("abs", POST).alias("absent_after"),
        total_of("can", PRE).alias("cancelled_before"),
        F.coalesce(F.max(F.when(of_member, F.col("total"))), F.lit(0)).cast("bigint").alias("total_rows"),
        F.min(F.when(of_member, F.col("first_day"))).alias("earliest_attendance"),
    )


def dropped_before_event() -> Column:
    """Q3: the pre-event profile loses a member whose every attendance row is an
    in-window cancelled session (the reference filters cancels in WHERE after a
    left join). Members without attendance rows stay."""
    return (F.col("total_rows") > 0) & (F.col("cancelled_before") == F.col("total_rows"))
