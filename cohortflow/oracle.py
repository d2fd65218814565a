"""DuckDB SQL for every query unit: the correctness oracle.

Written from the rules of SURVEY 2.11, with every constant spelt out here, so
a wrong constant or rule in the package shows. Its building blocks are facts
and flags, not the package's reductions: one row per (event, member,
attendance id) with a flag per window, then sums; EXISTS and NOT EXISTS over
edges for every state at a date. The driver tables are pre-registered views;
the adapters of FIXTURES.md (section B) are the first CTEs.
"""

from __future__ import annotations


def _plus_days(expr: str, n: int) -> str:
    return f"CAST(CAST({expr} AS DATE) + INTERVAL {n} DAY AS DATE)"


_MONTH0 = "CAST(date_trunc('month', o_orderdate) AS DATE)"

# The written date form of an order, by o_orderkey % 19.
_FORMS = [
    "%-m/%-d/%Y", "%Y-%m-%d", "%-m/%-d/%y", "%-m-%-d-%Y", "%-m/%-d/%Y 0:00", "%Y-%m-%d 00:00:00", "%Y-%m-%dT00:00:00", "%b %-d, %Y", "%-d %b %Y",
    "%-m/%-d/%Y 12:00:00 AM", "%Y/%m/%d", "%-d-%b-%y", "%-d-%b-%Y", "%B %-dth, %Y", "%b %-d %Y", "%Y-%m-%dT00:00:00Z", "%Y%m%d", "%-m.%-d.%Y",
    "%a %b %-d %Y",
]


def _written(day: str) -> str:
    return "CASE o_orderkey % 19 " + " ".join(f"WHEN {i} THEN strftime({day}, '{form}')" for i, form in enumerate(_FORMS)) + " END"


ADAPTERS = f"""
members AS (
  SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name,
         CAST(CASE WHEN c_custkey % 23 <> 0 THEN 1 + c_custkey % 7 END AS INTEGER) AS school_year_id,
         CAST(c_nationkey AS BIGINT) AS campus_id,
         CAST(CASE WHEN c_custkey % 29 <> 0 THEN 1 + c_custkey % 8 END AS INTEGER) AS user_role_type_id,
         (SELECT max(ts) FROM events WHERE events.user_id = c_custkey) AS last_login
  FROM customer
),
org_units AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS INTEGER) AS region_id FROM nation
),
registrations AS (
  SELECT CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS user_id,
         CASE WHEN o_orderkey % 53 <> 0 THEN o_orderpriority END AS event,
         {_MONTH0} AS start_date,
         CASE WHEN o_orderkey % 37 <> 0 THEN {_plus_days(_MONTH0, 3)} END AS end_date
  FROM orders
),
keyed_registrations AS (
  SELECT o_orderkey AS k, CAST(CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS DOUBLE) AS member_id,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              WHEN o_orderkey % 61 = 0 THEN o_orderpriority || ' CANCELLED'
              WHEN o_orderkey % 67 = 0 THEN o_orderpriority || ' été'
              ELSE o_orderpriority END AS event,
         CASE WHEN o_orderkey % 71 = 0 THEN 'TBD' ELSE {_written(_MONTH0)} END AS start_date,
         CASE WHEN o_orderkey % 37 <> 0 THEN {_written(_plus_days(_MONTH0, 3))} END AS end_date
  FROM orders
),
registrations_raw AS (
  SELECT * EXCLUDE k FROM keyed_registrations
),
program_event AS (
  SELECT CAST(rank() OVER (ORDER BY event, start_date, end_date) AS BIGINT) AS id, event AS name,
         CAST(left(event, 1) AS INTEGER) AS type_id, start_date, end_date
  FROM registrations
  WHERE event IS NOT NULL AND start_date IS NOT NULL AND end_date IS NOT NULL
  GROUP BY event, start_date, end_date
),
program_event_type AS (
  SELECT DISTINCT type_id AS id,
         CASE type_id WHEN 1 THEN 'Missions' WHEN 3 THEN 'Spiritual Impact Bootcamp' WHEN 4 THEN 'Summer Projects'
              WHEN 5 THEN 'Fathers House' WHEN 6 THEN 'SEEK' WHEN 7 THEN 'NST' WHEN 8 THEN 'SLS'
              ELSE 'Type ' || type_id END AS name
  FROM program_event WHERE type_id IS NOT NULL
),
event_attendees AS (
  SELECT DISTINCT e.id AS event_id, r.user_id
  FROM registrations r JOIN program_event e ON (e.name, e.start_date) = (r.event, r.start_date)
  WHERE r.user_id IS NOT NULL
),
sessions AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderstatus = 'P' OR o_custkey % 40 = 7 THEN 1 END AS cancel_reason_id
  FROM orders
),
attendance AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN -10 * o_custkey ELSE 10 * l_orderkey END + l_linenumber AS id,
         CASE WHEN NOT (o_custkey % 40 = 7 AND l_orderkey % 8 <> 0) THEN o_custkey END AS user_id,
         l_orderkey AS session_id, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS attended
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
mentorships AS (
  SELECT o_orderkey AS id,
         CASE WHEN NOT (o_custkey % 4 = 1 OR o_orderkey % 43 = 0) THEN o_custkey END AS user_id,
         CASE WHEN NOT (o_custkey < 10 OR o_custkey % 7 = 3) THEN CAST(o_custkey // 10 AS BIGINT) END AS parent_user_id,
         CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderstatus <> 'O' THEN {_plus_days('o_orderdate', 365)} END AS end_date
  FROM orders
),
outreach_outcomes AS (
  SELECT CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS user_id,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS outcome
  FROM orders
),
study_groups AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 1 THEN o_custkey END AS leader_id,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS deleted
  FROM orders
),
study_schedules AS (
  SELECT l_orderkey AS study_id, CAST(l_shipdate AS DATE) AS study_start_date,
         CASE WHEN l_linestatus <> 'O' THEN {_plus_days('l_shipdate', 365)} END AS study_end_date,
         CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS is_latest
  FROM lineitem
),
contact_chart AS (
  SELECT CASE WHEN o_custkey % 5 <> 2 THEN o_custkey END AS chart_owner_id,
         CASE WHEN l_partkey % 19 <> 0 THEN l_partkey END AS chart_member_id, CAST(l_shipdate AS DATE) AS start_date,
         CASE WHEN l_linestatus <> 'O' THEN {_plus_days('l_shipdate', 365)} END AS end_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

# Academic windows: the first month of the pre-window by the event's first month, and of the
# post-window's end by its last month, each with the years to add; the fiscal year turns in June.
WINDOWS = """
event_windows AS (
  SELECT id AS event_id, name AS event_name, type_id, start_date, end_date,
         make_date(CAST(year(start_date) - CASE WHEN month(start_date) <= 4 THEN 1 ELSE 0 END AS BIGINT),
                   CASE WHEN month(start_date) IN (1, 2, 12) THEN 9 WHEN month(start_date) = 3 THEN 10
                        WHEN month(start_date) = 4 THEN 11 WHEN month(start_date) <= 9 THEN 2
                        WHEN month(start_date) = 10 THEN 3 ELSE 4 END, 1) AS before_date,
         make_date(CAST(year(end_date) + CASE WHEN month(end_date) >= 9 THEN 1 ELSE 0 END AS BIGINT),
                   CASE WHEN month(end_date) <= 2 THEN 10 WHEN month(end_date) = 3 THEN 11 WHEN month(end_date) <= 8 THEN 12
                        WHEN month(end_date) = 9 THEN 2 WHEN month(end_date) = 10 THEN 3 WHEN month(end_date) = 11 THEN 4
                        ELSE 5 END, 1) AS after_date,
         CAST(year(end_date + INTERVAL 7 MONTH) AS INTEGER) AS fy
  FROM program_event
)"""

COHORT = """
cohort AS (
  SELECT user_id, event_windows.* FROM event_attendees JOIN event_windows USING (event_id)
),
keys AS (
  SELECT DISTINCT user_id, unnest([start_date, after_date]) AS t FROM cohort
),
cards AS (
  SELECT members.id AS user_id, first_name AS first, last_name AS last,
         CASE WHEN school_year_id BETWEEN 1 AND 6
              THEN ['Freshman', 'Sophomore', 'Junior', 'Senior', 'Senior+', 'Grad Student'][school_year_id] END AS year,
         org_units.name AS campus, region_id, last_login,
         user_role_type_id NOT IN (4, 6) AS role_fits,
         region_id <> 2 AND user_role_type_id NOT IN (4, 6) AND school_year_id BETWEEN 1 AND 6 AS eligible
  FROM members JOIN org_units ON campus_id = org_units.id
),
facts AS (
  SELECT a.user_id, a.id, a.attended, s.date, s.cancel_reason_id IS NOT NULL AS cancelled
  FROM attendance a LEFT JOIN sessions s ON s.id = a.session_id
  WHERE a.user_id IS NOT NULL
),
sightings AS (
  SELECT event_id, user_id, id, attended,
         bool_or(date BETWEEN before_date AND start_date) AS in_before, bool_or(date BETWEEN end_date AND after_date) AS in_after
  FROM cohort JOIN facts USING (user_id)
  WHERE NOT cancelled AND id IS NOT NULL
  GROUP BY event_id, user_id, id, attended
),
counts AS (
  SELECT event_id, user_id,
         count(*) FILTER (in_before AND attended = 1) AS came_before, count(*) FILTER (in_before AND attended = 0) AS missed_before,
         count(*) FILTER (in_after AND attended = 1) AS came_after, count(*) FILTER (in_after AND attended = 0) AS missed_after
  FROM sightings GROUP BY event_id, user_id
),
all_called_off AS (
  SELECT event_id, user_id FROM cohort JOIN facts USING (user_id)
  GROUP BY event_id, user_id
  HAVING bool_and(coalesce(cancelled AND date BETWEEN before_date AND start_date, false))
),
member_dates AS (
  SELECT id AS user_id,
         (SELECT min(date) FROM facts WHERE facts.user_id = members.id AND attended = 1 AND NOT cancelled) AS first_came,
         (SELECT min(start_date) FROM mentorships WHERE mentorships.user_id = members.id) AS first_mentored,
         (SELECT min(start_date) FROM mentorships WHERE parent_user_id = members.id) AS first_mentor,
         (SELECT min(study_start_date) FROM study_schedules WHERE study_id IN (SELECT g.id FROM study_groups g WHERE g.leader_id = members.id)) AS first_led,
         (SELECT CAST(max(outcome) AS VARCHAR) FROM outreach_outcomes o WHERE o.user_id = members.id) AS outcome
  FROM members
),
mentored AS (
  SELECT user_id, t, EXISTS (FROM mentorships e WHERE e.user_id = keys.user_id AND e.start_date <= t AND (e.end_date IS NULL OR e.end_date > t)) AS yes
  FROM keys
),
mentees AS (
  SELECT user_id, t, first_mentor,
         (SELECT count(DISTINCT e.user_id) FROM mentorships e
          WHERE e.parent_user_id = keys.user_id AND t BETWEEN e.start_date AND coalesce(e.end_date, t)) AS active
  FROM keys JOIN member_dates USING (user_id)
  WHERE EXISTS (FROM mentorships e WHERE e.parent_user_id = keys.user_id)
),
lines AS (  -- of every key: is the own mentorship alive, are there mentee edges, and what live mentees lead to
  SELECT user_id, t,
         EXISTS (FROM mentorships e WHERE e.user_id = keys.user_id AND coalesce(e.end_date, t) >= t) AS own_alive,
         EXISTS (FROM mentorships e WHERE e.parent_user_id = keys.user_id) AS mentors,
         EXISTS (FROM mentorships e JOIN mentorships g ON g.parent_user_id = e.user_id
                 WHERE e.parent_user_id = keys.user_id AND coalesce(e.end_date, t) >= t AND coalesce(g.end_date, t) >= t
                   AND g.user_id IS NOT NULL) AS has_grand,
         EXISTS (FROM mentorships e WHERE e.parent_user_id = keys.user_id AND coalesce(e.end_date, t) >= t
                   AND NOT EXISTS (FROM mentorships g WHERE g.parent_user_id = e.user_id)) AS childless,
         EXISTS (FROM mentorships e JOIN mentorships g ON g.parent_user_id = e.user_id
                 WHERE e.parent_user_id = keys.user_id AND coalesce(e.end_date, t) >= t AND coalesce(g.end_date, t) >= t
                   AND g.user_id IS NULL) AS unnamed_grand
  FROM keys
),
second_gen AS (
  SELECT user_id, t, CASE WHEN NOT mentors THEN 0 WHEN has_grand THEN 1 WHEN childless OR unnamed_grand THEN 0 END AS flag
  FROM lines WHERE own_alive
),
charts AS (
  SELECT keys.user_id, t, count(DISTINCT chart_member_id) AS people, max(start_date) AS latest
  FROM keys JOIN contact_chart ON chart_owner_id = keys.user_id AND t BETWEEN start_date AND coalesce(end_date, t)
  WHERE keys.user_id IN (SELECT id FROM members)
  GROUP BY keys.user_id, t
),
led_spans AS (
  SELECT DISTINCT leader_id, study_start_date AS from_day, study_end_date AS to_day
  FROM study_groups JOIN study_schedules ON study_id = study_groups.id
  WHERE deleted = 0 AND is_latest = 1 AND leader_id IN (SELECT id FROM members)
),
followers AS (
  SELECT DISTINCT keys.user_id, t, e.user_id AS mentee
  FROM keys JOIN mentorships e ON e.parent_user_id = keys.user_id AND coalesce(e.end_date, t) >= t
  WHERE keys.user_id IN (SELECT id FROM members)
),
chains AS (
  SELECT user_id, t, count(*) AS leaders FROM followers
  WHERE EXISTS (FROM led_spans WHERE leader_id = mentee AND t BETWEEN from_day AND coalesce(to_day, t))
  GROUP BY user_id, t
)"""

# Pre-event profile: the role rule only; a member whose rows are all called off inside the window drops out.
P1 = """
p1 AS (
  SELECT event_id, event_name, ty.name AS event_type, start_date, end_date, user_id, first, last, year, campus,
         first_came AS earliest_BSA, coalesce(came_before, 0) AS count_BSAtt, coalesce(missed_before, 0) AS count_BSAb,
         CAST(mentored.yes AS INTEGER) AS Was_D_at_start, outcome AS GP_outcome
  FROM cohort
  JOIN cards USING (user_id) JOIN member_dates USING (user_id)
  JOIN program_event_type ty ON ty.id = type_id
  JOIN mentored ON mentored.user_id = cohort.user_id AND mentored.t = start_date
  LEFT JOIN counts USING (event_id, user_id)
  WHERE role_fits AND NOT EXISTS (FROM all_called_off x WHERE x.event_id = cohort.event_id AND x.user_id = cohort.user_id)
)"""

# Post-event profile: all three rules, nobody drops out.
P2 = """
p2 AS (
  SELECT event_id, user_id, first_came AS earliest_BS_atten2, coalesce(came_after, 0) AS Attended2,
         coalesce(missed_after, 0) AS Absent2, CAST(mentored.yes AS INTEGER) AS Was_D_3_mo_After2, outcome AS GP_outcome_post2
  FROM cohort
  JOIN cards USING (user_id) JOIN member_dates USING (user_id)
  JOIN mentored ON mentored.user_id = cohort.user_id AND mentored.t = after_date
  LEFT JOIN counts USING (event_id, user_id)
  WHERE eligible
)"""


def _leadership(name: str, day: str, cols: list[str]) -> str:
    values = ["first_mentored", "first_led", "mentees.first_mentor", "people", "latest", "leaders", "active", "flag", "last_login"]
    listed = ", ".join(f'{value} AS "{col}"' for value, col in zip(values, cols))
    states = " ".join(
        f"LEFT JOIN {state} ON {state}.user_id = cohort.user_id AND {state}.t = {day}" for state in ("mentees", "charts", "chains", "second_gen")
    )
    return f"""
{name} AS (
  SELECT event_id, cohort.user_id, {listed}
  FROM cohort JOIN cards ON cards.user_id = cohort.user_id JOIN member_dates d ON d.user_id = cohort.user_id {states}
  WHERE eligible
)"""


L1_COLS = ["first_became_disciple", "earliest_led_bs", "first_became_DM", "count_of_DCC", "latest_change_to_DC",
           "slbs_in_chain", "number_of_D_at_start", "has_second_generation", "last_log_in"]
L2_COLS = ["first_became_disciple2", "earliest_led_bs2", "first_became_DM2", "count of DCC2", "latest_change_to_DC2",
           "slbs_in_chain2", "number_of_D_3_mo_later2", "has_second_generation2", "last_log_in2"]
L1 = _leadership("l1", "start_date", L1_COLS)
L2 = _leadership("l2", "after_date", L2_COLS)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([ADAPTERS, *ctes])


def _parsed(col: str) -> str:
    """The accepted written forms, by shape; a clock time behind the date is cut off first."""
    day = f"regexp_replace(trim({col}), '[ T][0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]+)?)?( AM|Z)?$', '')"
    others = "['%B %dth, %Y', '%b %d %Y', '%Y/%m/%d', '%d-%b-%y', '%d-%b-%Y', '%Y%m%d', '%m.%d.%Y', '%a %b %d %Y']"
    number, same = "[0-9]{1,2}", f"replace({day}, '-', '/')"
    long_forms = f"coalesce(try_strptime({same}, '%m/%d/%Y'), try_strptime({same}, '%d/%m/%Y'))"
    short_forms = f"coalesce(try_strptime({same}, '%m/%d/%y'), try_strptime({same}, '%d/%m/%y'))"
    names = f"coalesce(try_strptime({day}, '%b %d, %Y'), try_strptime({day}, '%B %d, %Y'), try_strptime({day}, '%d %b %Y'), try_strptime({day}, '%d %B %Y'), try_strptime({day}, {others}))"
    return (
        f"CAST(CASE WHEN regexp_full_match({day}, '{number}/{number}/[0-9]{{4}}|{number}-{number}-[0-9]{{4}}') THEN {long_forms} "
        f"WHEN regexp_full_match({day}, '{number}/{number}/[0-9]{{2}}|{number}-{number}-[0-9]{{2}}') THEN {short_forms} "
        f"WHEN regexp_full_match({day}, '[0-9]{{4}}-{number}-{number}') THEN try_strptime({day}, '%Y-%m-%d') "
        f"ELSE {names} END AS DATE)"
    )


# Lines of the registration file that are no rows, and the rows that the other lines hold.
DAMAGED = """
lines AS (
  SELECT *, k % 97 AS harm, coalesce(CAST(member_id AS VARCHAR), '') AS id_text, coalesce(event, '') AS event_text,
         coalesce(start_date, '') AS from_text, coalesce(end_date, '') AS to_text
  FROM keyed_registrations
),
damaged AS (
  SELECT CASE harm WHEN 1 THEN id_text || ',' || event_text
                   WHEN 2 THEN id_text || ',' || event_text || ',"' || from_text || '",' || CASE WHEN to_text = '' THEN '' ELSE '"' || to_text || '"' END || ',more'
                   WHEN 3 THEN id_text || ',"' || event_text || ',' || from_text || ',' || to_text
                   ELSE id_text || ',"' || event_text || '"x,' || from_text || ',' || to_text END AS line
  FROM lines WHERE harm BETWEEN 1 AND 4
)"""
UNDAMAGED = "\nregistrations_left AS (SELECT member_id, event, start_date, end_date FROM lines WHERE harm NOT BETWEEN 1 AND 4)"

PARSED = f"""
parsed AS (
  SELECT CAST(member_id AS BIGINT) AS user_id, event, {_parsed('start_date')} AS start_date, {_parsed('end_date')} AS end_date,
         start_date AS start_text, end_date AS end_text
  FROM registrations_raw
),
parsed_flagged AS (
  SELECT *, coalesce(trim(start_text) <> '' AND start_date IS NULL, false) OR coalesce(trim(end_text) <> '' AND end_date IS NULL, false) AS rejected
  FROM parsed
),
batch AS (
  SELECT DISTINCT event, start_date, end_date FROM parsed_flagged
  WHERE NOT rejected AND event IS NOT NULL AND start_date IS NOT NULL AND end_date IS NOT NULL
)"""

_LEAD_SELECT = ", ".join(f'{a}."{c}"' for a, cols in (("l1", L1_COLS), ("l2", L2_COLS)) for c in cols)
_STATES = (WINDOWS, COHORT)

# The event store after the batch, with the early part (before the split day) numbered first.
STORE = """
store AS (
  SELECT event, start_date, end_date,
         CAST(row_number() OVER (ORDER BY start_date >= DATE '1998-01-01', event, start_date, end_date) AS BIGINT) AS id
  FROM batch
)"""

ORACLE_SQL: dict[str, str] = {
    "registration_summary": _with(PARSED) + """
SELECT (SELECT count(*) FROM registrations_raw) AS raw_rows, CAST(0 AS BIGINT) AS screened_rows,
       (SELECT count(*) FROM parsed_flagged WHERE rejected) AS rejected_rows, CAST(0 AS BIGINT) AS malformed_rows,
       (SELECT count(*) FROM parsed_flagged WHERE NOT rejected) AS attendees_before,
       (SELECT count(*) FROM batch) AS unique_events,
       (SELECT count(*) FROM batch b WHERE EXISTS (FROM batch x WHERE x = b)) AS batch_events,
       (SELECT count(*) FROM (SELECT DISTINCT b, r.user_id FROM parsed_flagged r
          JOIN batch b ON (b.event, b.start_date) = (r.event, r.start_date)
          WHERE NOT r.rejected AND r.user_id IS NOT NULL)) AS attendees_after""",
    "registration_rejects": _with(DAMAGED, UNDAMAGED, PARSED.replace("registrations_raw", "registrations_left")) + """
SELECT user_id, event, start_text AS start_date, end_text AS end_date, NULL AS malformed FROM parsed_flagged WHERE rejected
UNION ALL SELECT NULL, NULL, NULL, NULL, line FROM damaged""",
    "damaged_registration_summary": _with(DAMAGED, UNDAMAGED, PARSED.replace("registrations_raw", "registrations_left")) + """
SELECT (SELECT count(*) FROM lines) AS raw_rows, CAST(0 AS BIGINT) AS screened_rows,
       (SELECT count(*) FROM damaged) + (SELECT count(*) FROM parsed_flagged WHERE rejected) AS rejected_rows,
       (SELECT count(*) FROM damaged) AS malformed_rows,
       (SELECT count(*) FROM parsed_flagged WHERE NOT rejected) AS attendees_before,
       (SELECT count(*) FROM batch) AS unique_events, (SELECT count(*) FROM batch) AS batch_events,
       (SELECT count(*) FROM (SELECT DISTINCT b, r.user_id FROM parsed_flagged r
          JOIN batch b ON (b.event, b.start_date) = (r.event, r.start_date)
          WHERE NOT r.rejected AND r.user_id IS NOT NULL)) AS attendees_after""",
    "registration_screen": _with() + """
SELECT * FROM registrations_raw
WHERE coalesce(NOT contains(upper(event), 'CANCELLED') AND NOT regexp_matches(event, '[^\\x00-\\x7F]'), true)
  AND coalesce(member_id NOT IN (SELECT id FROM members WHERE user_role_type_id IN (4, 6)), true)""",
    "parsed_registration_dates": _with(PARSED) + """
SELECT user_id, event, start_date, end_date, start_text, end_text, CAST(NULL AS VARCHAR) AS malformed, rejected FROM parsed_flagged""",
    "program_events": _with() + """
SELECT * FROM program_event""",
    "program_events_upsert": _with() + """,
split AS (SELECT *, start_date < DATE '1998-01-01' AS stored FROM program_event)
SELECT CAST((SELECT count(*) FROM split WHERE stored) + row_number() OVER (ORDER BY name, start_date, end_date) AS BIGINT) AS id,
       name, type_id, start_date, end_date
FROM split WHERE NOT stored""",
    "attendees_upsert": _with(PARSED, STORE) + """
SELECT DISTINCT id AS event_id, user_id FROM parsed_flagged r JOIN store s ON (s.event, s.start_date) = (r.event, r.start_date)
WHERE NOT rejected AND user_id IS NOT NULL AND r.start_date >= DATE '1998-01-01'""",
    "batch_event_ids": _with(PARSED) + """
SELECT event, start_date, end_date, id AS event_id
FROM batch JOIN (SELECT id, name AS event, start_date, end_date FROM program_event) USING (event, start_date, end_date)""",
    "event_attendees": _with() + """
SELECT event_id, user_id FROM event_attendees""",
    "calendar_windows": _with(WINDOWS) + """
SELECT event_id, before_date, start_date, end_date, after_date, fy FROM event_windows""",
    "cohort_windows": _with(*_STATES) + """
SELECT event_id, user_id, event_name, type_id, start_date, end_date, before_date, after_date, fy FROM cohort""",
    "event_type_attendance": _with(*_STATES) + """
SELECT type_id, ty.name AS event_type, count(DISTINCT event_id) AS events, count(*) AS attendees
FROM cohort JOIN program_event_type ty ON ty.id = type_id GROUP BY ALL""",
    "eligible_members": _with(*_STATES) + """
SELECT user_id, first, last, year, campus, region_id, last_login FROM cards WHERE eligible""",
    "attendance_before": _with(*_STATES, P1) + """
SELECT event_id, user_id, count_BSAtt AS attended, count_BSAb AS absent FROM p1""",
    "attendance_after": _with(*_STATES, P2) + """
SELECT event_id, user_id, Attended2 AS attended, Absent2 AS absent FROM p2""",
    "earliest_attendance": _with(*_STATES) + """
SELECT user_id, min(date) AS earliest_attendance FROM facts WHERE attended = 1 AND NOT cancelled AND date IS NOT NULL GROUP BY user_id""",
    "earliest_mentored": _with() + """
SELECT user_id, min(start_date) AS first_became_disciple FROM mentorships WHERE user_id IS NOT NULL GROUP BY user_id""",
    "mentored_as_of": _with(*_STATES) + """
SELECT event_id, user_id, CAST(s.yes AS INTEGER) AS flag_at_start, CAST(a.yes AS INTEGER) AS flag_after
FROM cohort c JOIN mentored s USING (user_id) JOIN mentored a USING (user_id)
WHERE s.t = c.start_date AND a.t = c.after_date""",
    "outreach_outcome": _with() + """
SELECT user_id, CAST(max(outcome) AS VARCHAR) AS outcome FROM outreach_outcomes WHERE user_id IS NOT NULL GROUP BY user_id""",
    "mentor_activity": _with(*_STATES) + """
SELECT user_id, t AS as_of, first_mentor AS first_became_DM, active AS active_mentees FROM mentees""",
    "earliest_led_study": _with() + """
SELECT leader_id AS user_id, min(study_start_date) AS earliest_led_bs
FROM study_groups JOIN study_schedules ON study_id = study_groups.id WHERE leader_id IS NOT NULL GROUP BY leader_id""",
    "second_generation": _with(*_STATES) + """
SELECT user_id, t AS as_of, CAST(flag AS INTEGER) AS has_second_generation FROM second_gen WHERE flag IS NOT NULL""",
    "contact_chart_depth": _with(*_STATES) + """
SELECT user_id, t AS as_of, people AS count_of_DCC, latest AS latest_change_to_DC FROM charts""",
    "leaders_in_chain": _with(*_STATES) + """
SELECT user_id, t AS as_of, leaders AS slbs_in_chain FROM chains""",
    "pre_event_profile": _with(*_STATES, P1) + """
SELECT * FROM p1""",
    "post_event_profile": _with(*_STATES, P2) + """
SELECT * FROM p2""",
    "leadership_at_start": _with(*_STATES, L1) + """
SELECT * FROM l1""",
    "leadership_after": _with(*_STATES, L2) + """
SELECT * FROM l2""",
    "stacked_batches": _with(*_STATES, P1) + """
SELECT p1.*, CASE WHEN late THEN after_date END AS "3_mo_after", CASE WHEN late THEN fy END AS "FY"
FROM p1 JOIN (SELECT event_id, start_date >= DATE '1998-01-01' AS late, after_date, fy FROM event_windows) USING (event_id)""",
    "event_dataset": _with(*_STATES, P1, P2, L1, L2) + f"""
SELECT p1.* EXCLUDE (event_id), w.after_date AS "3_mo_after", w.fy AS "FY", p2.* EXCLUDE (event_id, user_id), {_LEAD_SELECT}
FROM p1 JOIN event_windows w USING (event_id) JOIN p2 USING (event_id, user_id) JOIN l1 USING (event_id, user_id) JOIN l2 USING (event_id, user_id)""",
}

ORACLE_SQL["dataset_files"] = ORACLE_SQL["event_dataset"]
