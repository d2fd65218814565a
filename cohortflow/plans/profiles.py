"""The four per-event profiles (M1-M4) and the wide dataset (M5), as one set-based plan.

Every event of the batch is measured at once: there is no loop over events.
A profile is a population of cohort rows (event_id, user_id) plus metrics
joined to it:

* attendance counts per cohort row (`operators.attendance`), running sums over
  per-member-day facts read at the ends of the windows;
* date-dependent metrics per cohort row (`operators.asof`), one sweep over
  intervals and probes at the start date and at the post-window end;
* per-member facts that take no date (`operators.per_member`), one groupBy
  over all sources;
* the member profile (`operators.cohort.member_profiles`).

Populations (reference semantics kept, SURVEY 2.11):
  pre   (M1): campus join, role rule, event type join, minus the Q3 drop;
  post  (M2), leadership (M3, M4): campus join, region, role and school-year rules;
  dataset (M5): M1 rows that M2-M4 also hold, joined on (event_id, user_id) (Q2 fixed).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CohortRules
from ..functions.calendar import DEFAULT_CALENDAR, AcademicCalendar
from ..operators import asof, attendance, cohort, leadership, mentorship, per_member
from ..sources.scratch import materialize
from ..sources.tables import CohortInputs

KEYS = ["event_id", "user_id"]

# Output column lists (names and order fixed by the reference's dataset).
PRE_COLUMNS = [
    "event_name", "event_type", "start_date", "end_date", "user_id", "first", "last", "year", "campus",
    "earliest_BSA", "count_BSAtt", "count_BSAb", "Was_D_at_start", "GP_outcome",
]
POST_COLUMNS = ["user_id", "earliest_BS_atten2", "Attended2", "Absent2", "Was_D_3_mo_After2", "GP_outcome_post2"]
LEAD_START_COLUMNS = [
    "user_id", "first_became_disciple", "earliest_led_bs", "first_became_DM", "count_of_DCC",
    "latest_change_to_DC", "slbs_in_chain", "number_of_D_at_start", "has_second_generation", "last_log_in",
]
LEAD_AFTER_COLUMNS = [
    "user_id", "first_became_disciple2", "earliest_led_bs2", "first_became_DM2", "count of DCC2",
    "latest_change_to_DC2", "slbs_in_chain2", "number_of_D_3_mo_later2", "has_second_generation2", "last_log_in2",
]
DATASET_COLUMNS = [
    "event_name", "event_type", "start_date", "end_date", "3_mo_after", "FY",
    "user_id", "first", "last", "year", "campus", "earliest_BSA", "count_BSAtt", "count_BSAb", "Was_D_at_start", "GP_outcome",
    "earliest_BS_atten2", "Attended2", "Absent2", "Was_D_3_mo_After2", "GP_outcome_post2",
    *LEAD_START_COLUMNS[1:],
    *LEAD_AFTER_COLUMNS[1:],
]


@dataclass(frozen=True)
class CohortPlan:
    """Builds the profiles from one set of inputs (one consistent snapshot, as the
    reference reads all four queries after its writes)."""

    inputs: CohortInputs
    rules: CohortRules = field(default_factory=CohortRules)
    calendar: AcademicCalendar = DEFAULT_CALENDAR
    batch_event_ids: DataFrame | None = None
    # Tables that are the same for every batch of the inputs, written once; plans of other batches may be given the same dictionary.
    shared: dict | None = None
    _memo: dict = field(default_factory=dict, repr=False, compare=False)

    # -- building blocks -------------------------------------------------
    def cohort(self, with_type: bool = False) -> DataFrame:
        """M0 over the batch (with the J5 type join when `with_type`), written once to
        the shared checkpoint folder: the branches read it back instead of
        computing it again, and its lineage is cut."""
        key = f"cohort_{with_type}"
        if key not in self._memo:
            rows = cohort.attendee_windows(self.inputs.event_attendees, self.events(with_type))
            self._memo[key] = materialize(rows, "cohort")
        return self._memo[key]

    def events(self, with_type: bool = False) -> DataFrame:
        """The batch's event dimension (J5 type join when `with_type`), written once."""
        key = f"events_{with_type}"
        if key not in self._memo:
            types = self.inputs.program_event_type if with_type else None
            rows = cohort.event_dimension(self.inputs.program_event, self.batch_event_ids, types, self.calendar)
            self._memo[key] = materialize(rows, "events")
        return self._memo[key]

    def population(self, kind: str) -> DataFrame:
        i = self.inputs
        if kind == "pre":
            rows = self.cohort(with_type=True)
            members = cohort.member_profiles(i.members, i.org_units, self.rules, apply_region=False, apply_school_year=False)
        elif kind == "post":
            rows = self.cohort()
            members = cohort.member_profiles(i.members, i.org_units, self.rules)
        elif kind == "dataset":
            rows = self.cohort(with_type=True)
            members = cohort.member_profiles(i.members, i.org_units, self.rules)
        else:
            raise ValueError(kind)
        return rows.join(members, "user_id")

    def bounds(self) -> Column | None:
        """The batch's time span as one scalar subquery over the (small) event dimension:
        first_window_day (earliest pre-window start), first_probe (earliest start date),
        last_day (latest post-window end). Every window and every as-of date lies inside.

        Only for a batch that is a subset of the stored events (None otherwise): a
        whole-store run spans all history, so the facts would not shrink."""
        if self.batch_event_ids is None:
            return None
        if "bounds" not in self._memo:
            self._memo["bounds"] = self.events().select(
                F.struct(
                    F.min("before_date").alias("first_window_day"),
                    F.min("start_date").alias("first_probe"),
                    F.max("after_date").alias("last_day"),
                )
            ).scalar()
        return self._memo["bounds"]

    def attendance_counts(self, pop: DataFrame) -> DataFrame:
        b = self.bounds()
        span = None if b is None else (b.getField("first_window_day"), b.getField("last_day"))
        if self.shared is None:
            days = materialize(self.member_days(span), "member_days")
        else:
            days = attendance.facts_within(self.common("member_days", lambda: self.member_days(None)), span)
        return attendance.attendance_windows(pop, days, days.count() + self.cohort("cohort_True" in self._memo).count())

    def member_days(self, span: tuple[Column, Column] | None) -> DataFrame:
        i = self.inputs
        if self.shared is None:
            events = self.events("events_True" in self._memo)
        else:  # the longest window of any batch
            events = cohort.event_windows(i.program_event, self.calendar)
        longest = events.select(
            F.max(F.greatest(F.datediff("start_date", "before_date"), F.datediff("after_date", "end_date")))
        ).scalar()
        return attendance.window_facts(attendance.session_facts(i.attendance, i.sessions), span, longest)

    def common(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that no batch changes, written once for this plan and those that share with it."""
        kept = self._memo if self.shared is None else self.shared
        if name not in kept:
            kept[name] = materialize(build(), name)
        return kept[name]

    def as_of_span(self) -> tuple[Column, Column] | None:
        """First and last as-of date of the batch: from its first start date to its
        last post-window end. None for a run over the whole store."""
        b = self.bounds()
        return None if b is None else (b.getField("first_probe"), b.getField("last_day"))

    def intervals(self, kinds: tuple[int, ...], span: tuple[Column, Column] | None) -> DataFrame:
        """The intervals of the kinds, limited to rows that can hold at some as-of date of the span."""
        i = self.inputs
        leaders = None
        if asof.CHAIN in kinds:
            leaders = leadership.leader_intervals(i.study_groups, i.study_schedules, i.members)
        return asof.interval_rows(i.mentorships, self.contact_chart() if asof.CONTACT in kinds else None, kinds, leaders, span)

    def contact_chart(self) -> DataFrame:
        """Read twice: for the number of contacts and for the latest start."""
        return self.common("contact_chart", lambda: self.inputs.contact_chart)

    def as_of(self, rows: DataFrame, times: dict[str, str], kinds: tuple[int, ...], keys: list[str] = KEYS) -> DataFrame:
        """As-of metrics for cohort rows; eligibility is applied when the profile
        joins the metrics back."""
        span, contacts = self.as_of_span(), None
        if self.shared is None:
            changed = asof.changes(self.intervals(kinds, span))
            if asof.CONTACT in kinds:
                contacts = asof.contact_starts(self.contact_chart(), span)
        else:
            name = "changes_" + "_".join(map(str, kinds))
            changed = self.common(name, lambda: asof.changes(self.intervals(kinds, None)))
            if asof.CONTACT in kinds:
                contacts = self.common("contact_starts", lambda: asof.contact_starts(self.contact_chart()))
            if span is not None:  # a change behind the last date counts nowhere
                changed = changed.where(F.col("_t") <= span[1])
                contacts = contacts if contacts is None else contacts.where((F.col("last_end") >= span[0]) & (F.col("start_date") <= span[1]))
        return asof.swept(rows, keys, times, changed, contacts)

    def member_facts(self, parts: tuple[str, ...]) -> DataFrame:
        i = self.inputs
        builders = {
            "mentee": lambda: mentorship.as_mentee(i.mentorships),
            "mentor": lambda: mentorship.as_mentor(i.mentorships),
            "second_generation": lambda: mentorship.second_generation(i.mentorships),
            "led": lambda: leadership.led_studies(i.study_groups, i.study_schedules),
            "outcome": lambda: leadership.outcome(i.outreach_outcomes),
        }
        facts = lambda: per_member.combine([builders[p]() for p in parts])
        return facts() if self.shared is None else self.common("facts_" + "_".join(parts), facts)

    # -- column formulas --------------------------------------------------
    @staticmethod
    def leadership_columns(sfx: str, t: Column, names: list[str]) -> list[Column]:
        v = lambda c: F.col(f"{c}_{sfx}")
        values = [
            F.col("first_became_disciple"),
            F.col("earliest_led_bs"),
            F.col("first_became_dm"),
            F.when(v("contact_latest").isNotNull(), v("contacts")).cast("bigint"),
            v("contact_latest"),
            F.when(v("chain") > 0, v("chain")).cast("bigint"),
            F.when(F.col("is_mentor") == 1, F.coalesce(v("mentees"), F.lit(0))).cast("bigint"),
            mentorship.second_generation_at(t, F.col("d1_end"), F.col("is_mentor"), F.col("m1"), F.col("m0")),
            F.col("last_login"),
        ]
        return [val.alias(name) for val, name in zip(values, names[1:])]

    @staticmethod
    def _mentored(sfx: str) -> Column:
        return F.coalesce(F.col(f"mentored_{sfx}"), F.lit(0)).cast("int")

    # -- single metrics (query units) -------------------------------------------
    def attendance_before(self) -> DataFrame:
        """Pre-window counts over the M1 population (Q3 applied)."""
        pop = self.population("pre")
        counts = self.attendance_counts(pop).where(~attendance.dropped_before_event())
        return counts.select(
            "event_id", "user_id", F.col("attended_before").alias("attended"), F.col("absent_before").alias("absent")
        )

    def attendance_after(self) -> DataFrame:
        """Post-window counts over the M2 population."""
        counts = self.attendance_counts(self.population("post"))
        return counts.select(
            "event_id", "user_id", F.col("attended_after").alias("attended"), F.col("absent_after").alias("absent")
        )

    def mentored_as_of(self) -> DataFrame:
        """J8 flag (F10) for every cohort row, at the start date and the post-window end."""
        rows = self.cohort()
        flags = self.as_of(rows, {"s": "start_date", "a": "after_date"}, (asof.MENTORED,))
        return rows.join(flags, KEYS, "left").select(
            "event_id", "user_id", self._mentored("s").alias("flag_at_start"), self._mentored("a").alias("flag_after")
        )

    def key_metrics(self, kinds: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
        """As-of metrics per distinct (user_id, as_of) key of the cohort."""
        keys = cohort.as_of_keys(self.cohort())
        return keys, self.as_of(keys, {"k": "as_of"}, kinds, ["user_id", "as_of"])

    def members_only(self, df: DataFrame) -> DataFrame:
        """Rows of members only (the reference's derived tables join the member table)."""
        return df.join(self.inputs.members.select(F.col("id").alias("user_id")), "user_id", "left_semi")

    def mentor_activity(self) -> DataFrame:
        """A3 + A4 for keys of members who mentor: first time as mentor, active mentees at the key."""
        keys, m = self.key_metrics((asof.MENTEE,))
        mentors = mentorship.as_mentor(self.inputs.mentorships).table()
        rows = self.members_only(keys.join(mentors, "user_id").join(m, ["user_id", "as_of"], "left"))
        return rows.select(
            "user_id", "as_of", F.col("first_became_dm").alias("first_became_DM"),
            F.coalesce(F.col("mentees_k"), F.lit(0)).cast("bigint").alias("active_mentees"),
        )

    def second_generation(self) -> DataFrame:
        """A7 per key, only where the reference's derived table has a row (flag not null)."""
        keys = cohort.as_of_keys(self.cohort())
        facts = self.member_facts(("mentee", "mentor", "second_generation"))
        flag = mentorship.second_generation_at(F.col("as_of"), F.col("d1_end"), F.col("is_mentor"), F.col("m1"), F.col("m0"))
        return keys.join(facts, "user_id").select("user_id", "as_of", flag.alias("has_second_generation")).where(
            F.col("has_second_generation").isNotNull()
        )

    def contact_chart_depth(self) -> DataFrame:
        """A6 per key with active chart rows: distinct members and latest start."""
        _, m = self.key_metrics((asof.CONTACT,))
        return self.members_only(m.where(F.col("contact_latest_k").isNotNull())).select(
            "user_id", "as_of", F.col("contacts_k").alias("count_of_DCC"),
            F.col("contact_latest_k").alias("latest_change_to_DC"),
        )

    def leaders_in_chain(self) -> DataFrame:
        """A8 per key with at least one live study leader among live mentees."""
        _, m = self.key_metrics((asof.CHAIN,))
        return self.members_only(m.where(F.col("chain_k") > 0)).select("user_id", "as_of", F.col("chain_k").alias("slbs_in_chain"))

    # -- profiles ------------------------------------------------------------
    def pre_event_profile(self) -> DataFrame:
        """M1: event, member and pre-window columns, keyed by event_id."""
        pop = self.population("pre")
        counts = self.attendance_counts(pop)
        flags = self.as_of(self.cohort(with_type=True), {"s": "start_date"}, (asof.MENTORED,))
        facts = self.member_facts(("outcome",))
        rows = (
            pop.join(facts, "user_id", "left")
            .join(counts, KEYS)
            .where(~attendance.dropped_before_event())
            .join(flags, KEYS, "left")
        )
        return rows.select(
            "event_id", "event_name", "event_type", "start_date", "end_date", "user_id", "first", "last", "year", "campus",
            F.col("earliest_attendance").alias("earliest_BSA"),
            F.col("attended_before").alias("count_BSAtt"),
            F.col("absent_before").alias("count_BSAb"),
            self._mentored("s").alias("Was_D_at_start"),
            F.col("outcome").alias("GP_outcome"),
        )

    def post_event_profile(self) -> DataFrame:
        """M2: post-window columns, keyed by event_id."""
        pop = self.population("post")
        counts = self.attendance_counts(pop)
        flags = self.as_of(self.cohort(), {"a": "after_date"}, (asof.MENTORED,))
        facts = self.member_facts(("outcome",))
        rows = pop.join(facts, "user_id", "left").join(counts, KEYS).join(flags, KEYS, "left")
        return rows.select(
            "event_id", "user_id",
            F.col("earliest_attendance").alias("earliest_BS_atten2"),
            F.col("attended_after").alias("Attended2"),
            F.col("absent_after").alias("Absent2"),
            self._mentored("a").alias("Was_D_3_mo_After2"),
            F.col("outcome").alias("GP_outcome_post2"),
        )

    def leadership_profile(self, at: str) -> DataFrame:
        """M3 (at="start", t = start date) or M4 (at="after", t = post-window end)."""
        pop = self.population("post")
        sfx, tcol, names = ("s", "start_date", LEAD_START_COLUMNS) if at == "start" else ("a", "after_date", LEAD_AFTER_COLUMNS)
        metrics = self.as_of(self.cohort(), {sfx: tcol}, (asof.MENTEE, asof.CONTACT, asof.CHAIN))
        facts = self.member_facts(("mentee", "mentor", "second_generation", "led"))
        rows = pop.join(facts, "user_id", "left").join(metrics, KEYS, "left")
        return rows.select("event_id", "user_id", *self.leadership_columns(sfx, F.col(tcol), names))

    def event_dataset(self) -> DataFrame:
        """M5: the 39-column dataset, one row per (event, member), built once for all events."""
        pop = self.population("dataset")
        counts = self.attendance_counts(pop)
        metrics = self.as_of(self.cohort(with_type=True), {"s": "start_date", "a": "after_date"}, asof.ALL_KINDS)
        facts = self.member_facts(("mentee", "mentor", "second_generation", "led", "outcome"))
        rows = (
            pop.join(facts, "user_id", "left")  # per-member facts first, while pop is partitioned by user_id
            .join(counts, KEYS)
            .where(~attendance.dropped_before_event())
            .join(metrics, KEYS, "left")
        )
        return rows.select(
            "event_name", "event_type", "start_date", "end_date",
            F.col("after_date").alias("3_mo_after"),
            F.col("fy").alias("FY"),
            "user_id", "first", "last", "year", "campus",
            F.col("earliest_attendance").alias("earliest_BSA"),
            F.col("attended_before").alias("count_BSAtt"),
            F.col("absent_before").alias("count_BSAb"),
            self._mentored("s").alias("Was_D_at_start"),
            F.col("outcome").alias("GP_outcome"),
            F.col("earliest_attendance").alias("earliest_BS_atten2"),
            F.col("attended_after").alias("Attended2"),
            F.col("absent_after").alias("Absent2"),
            self._mentored("a").alias("Was_D_3_mo_After2"),
            F.col("outcome").alias("GP_outcome_post2"),
            *self.leadership_columns("s", F.col("start_date"), LEAD_START_COLUMNS),
            *self.leadership_columns("a", F.col("after_date"), LEAD_AFTER_COLUMNS),
        )
