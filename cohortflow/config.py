"""Run parameters: eligibility rules and event type of a registration batch."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CohortRules:
    """Member filters. Null region, role or school year never passes a rule that applies.

    `excluded_regions` applies to the post-event and leadership profiles only
    (the pre-event profile has it switched off); `excluded_roles` applies
    everywhere; `school_years` applies like the region rule. The wide dataset
    inner-joins all profiles, so it ends up with all three (Q4).
    """

    # The reference's exclusion and inclusion lists.
    excluded_regions: tuple[int, ...] = (10, 26, 44, 45)
    excluded_roles: tuple[int, ...] = (4, 6)
    school_years: tuple[int, ...] = (1, 2, 3, 4, 5, 6)


# Settings used with the driver fixture (its regions are 0..4).
FIXTURE_RULES = CohortRules(excluded_regions=(2,))
