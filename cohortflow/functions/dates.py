"""Parsing of the registration file's free-text dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: two-digit years below this are 20xx, the others 19xx.
CENTURY_PIVOT = 69
# The months as they are written; the place in the list is the month.
MONTHS = (
    ("jan", "january"), ("feb", "february"), ("mar", "march"), ("apr", "april"), ("may",), ("jun", "june"),
    ("jul", "july"), ("aug", "august"), ("sep", "sept", "september"), ("oct", "october"), ("nov", "november"), ("dec", "december"),
)

# A weekday before the date and a clock time after it, with a zone or not, are allowed and ignored.
_WEEKDAY = r"^(mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun|monday|tuesday|wednesday|thursday|friday|saturday|sunday)\.?,? +"
_CLOCK = r"[ t]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[ap]\.?m\.?)?( ?(z|utc|gmt|[+-]\d{2}:?\d{2}))?$"
_NUMBERS = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})$"
_YEAR_FIRST = r"^(\d{4})([/.-])(\d{1,2})\2(\d{1,2})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_MONTH_DAY = r"^([a-z]{3,9})\.?[ -]+(\d{1,2})(?:st|nd|rd|th)?(?:,? +|,|-)(\d{4})$"
_DAY_MONTH = r"^(\d{1,2})(?:st|nd|rd|th)?[ -]+([a-z]{3,9})\.?(?:,? +|,|-)(\d{4}|\d{2})$"


def parse_date_text(text: Column) -> Column:
    """Text -> DateType, null when no form matches.

    The form is chosen by its shape, so a text is parsed once. Case does not
    matter. In this order:

    1. ``10/3/2015``, ``10-3-2015`` or ``10.3.2015``: month first; day first only
       where the first number cannot be a month (``13/1/2015`` is 13 January);
       also with a two-digit year;
    2. ``2015-10-03``, ``2015/10/03`` or ``2015.10.03`` (also without leading zeros);
    3. ``20151003``;
    4. ``Oct 3, 2015``, ``October 3rd, 2015`` or ``Oct 3 2015`` (also ``Sept``);
    5. ``3 Oct 2015``, ``3rd October 2015``, ``3-Oct-2015`` or ``3-Oct-15``.

    A weekday may come before (``Sat Oct 3 2015``) and a clock time after it
    (``2015-10-03T00:00:00Z``, ``10/3/2015 12:00:00 AM``).
    """
    day = F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), _CLOCK, ""), _WEEKDAY, "")
    month_of = F.create_map(*[F.lit(x) for i, names in enumerate(MONTHS, start=1) for name in names for x in (name, str(i))])

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(day, pattern, group)

    def date(year: Column, month: Column, day_: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", year, month, day_), "yyyy-M-d")

    def full(year: Column) -> Column:
        century = F.when(year.try_cast("int") < CENTURY_PIVOT, F.lit("20")).otherwise(F.lit("19"))
        return F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)

    def named(pattern: str, name: int, number: int) -> Column:
        month = month_of[part(pattern, name)]  # no such month: null, and so is the date
        return F.when(month.isNotNull(), date(full(part(pattern, 3)), month, part(pattern, number)))

    first, second, year = part(_NUMBERS, 1), part(_NUMBERS, 3), full(part(_NUMBERS, 4))
    return (
        F.when(day.rlike(_NUMBERS), F.when(first.try_cast("int") <= 12, date(year, first, second)).otherwise(date(year, second, first)))
        .when(day.rlike(_YEAR_FIRST), date(part(_YEAR_FIRST, 1), part(_YEAR_FIRST, 3), part(_YEAR_FIRST, 4)))
        .when(day.rlike(_COMPACT), date(part(_COMPACT, 1), part(_COMPACT, 2), part(_COMPACT, 3)))
        .when(day.rlike(_MONTH_DAY), named(_MONTH_DAY, 1, 2))
        .when(day.rlike(_DAY_MONTH), named(_DAY_MONTH, 2, 1))
    )


def unparseable(text: Column, parsed: Column) -> Column:
    """True when non-null text failed to parse: the row goes to the reject table."""
    return text.isNotNull() & (F.trim(text) != F.lit("")) & parsed.isNull()
