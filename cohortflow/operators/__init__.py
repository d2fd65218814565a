"""DataFrame operators: registration, cohort, attendance, as-of intervals, mentorship, leadership."""
