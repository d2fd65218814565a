"""Event cohort metrics on Spark.

Registers program events and their attendees, then measures every attendee
before and after each event (study-session attendance, mentorship state and
reach, contact chart, study leadership, outreach outcome) in one set-based
DataFrame plan. Start with `plans.profiles.CohortPlan` or `plans.job.run`.
"""

from .config import CohortRules, FIXTURE_RULES
from .functions.calendar import DEFAULT_CALENDAR, AcademicCalendar
from .plans.profiles import DATASET_COLUMNS, CohortPlan
from .sources.tables import CohortInputs, read_catalog_tables, read_native_tables, read_registrations_csv

__all__ = [
    "AcademicCalendar",
    "CohortInputs",
    "CohortPlan",
    "CohortRules",
    "DATASET_COLUMNS",
    "DEFAULT_CALENDAR",
    "FIXTURE_RULES",
    "read_catalog_tables",
    "read_native_tables",
    "read_registrations_csv",
]
