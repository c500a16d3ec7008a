"""Month and hour texts, date parsing and month offsets."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean length of a month in days, by which day spans are turned into month offsets.
DAYS_PER_MONTH = 30.44


def month_text(month: Column) -> Column:
    """`yyyy-MM` text of a date."""
    return F.substring(month.cast("string"), 1, 7)


def hour_text(hour: Column) -> Column:
    """Two-digit text of an hour number."""
    return F.lpad(hour.cast("string"), 2, "0")


MONTH_FIRST, DAY_FIRST, YEAR_FIRST, NAMED = DATE_ORDERS = ("month first", "day first", "year first", "named month")
# Months as dates name them.
MONTHS = "january february march april may june july august september october november december".split()
_SHORT = {name[:3]: number for number, name in enumerate(MONTHS, 1)} | {"sept": 9}
MONTH_NUMBERS = {name: number for number, name in enumerate(MONTHS, 1)} | _SHORT

_DAY_NAME = r"^(?:[A-Za-z]{3,9},? )?"
_NAMED_DATES = (_DAY_NAME + r"(\d{1,2})[ -]([A-Za-z]{3,9})\.?[ ,-]+(\d{4})", _DAY_NAME + r"([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4})")
_HALF_DAY = r"[AaPp]\.?[Mm]\.?"
_MARK = "\u0001"
_TWELVE = rf"^(\S+)[T ]\s*(0?[1-9]|1[0-2])(:\d{{2}}(?::\d{{2}}(?:\.\d{{1,6}})?)?)\s*({_HALF_DAY})$"


@dataclass(frozen=True)
class DateFormat:
    """How the dates of a file are written; those that begin with a year of four digits are read whatever their order."""

    order: str = MONTH_FIRST
    twelve_hours: bool = False
    short_years: bool = False


def date_format_of(texts: list[str]) -> DateFormat:
    """The format that most of these texts have; numbers that may be either a month or a day are the month first."""
    texts = [text.strip() for text in texts]

    def most(pattern: str) -> bool:
        return 2 * sum(bool(re.search(pattern, text)) for text in texts) > len(texts)

    day_first = sum(bool(re.match(r"(1[3-9]|2\d|3[01])[/.-]\d", text)) for text in texts)
    month_first = sum(bool(re.match(r"\d{1,2}[/.-](1[3-9]|2\d|3[01])[/.-]", text)) for text in texts)
    order = DAY_FIRST if day_first > month_first else MONTH_FIRST
    if most(r"^\d{4}[/.-]"):
        order = YEAR_FIRST
    if most(r"^(?:[A-Za-z]{3,9},? )?(?:\d{1,2}[ -][A-Za-z]{3}|[A-Za-z]{3,9}\.? \d)"):
        order = NAMED
    return DateFormat(order, most(rf"{_HALF_DAY}$"), most(r"^\d{1,2}([/.-])\d{1,2}\1\d{2}(?!\d)"))


def _iso_named(text: Column) -> Column:
    """The same with the date as numbers, the year first."""
    pairs = F.create_map(*[F.lit(str(one)) for pair in MONTH_NUMBERS.items() for one in pair])
    found = F.when(F.lit(False), text)
    for pattern, (day, month) in zip(_NAMED_DATES, ((1, 2), (2, 1)), strict=True):
        number = F.try_element_at(pairs, F.lower(F.regexp_extract(text, pattern, month)))
        rest = F.regexp_replace(text, pattern, "")
        date = F.concat(F.regexp_extract(text, pattern, 3), F.lit("-"), number, F.lit("-"), F.regexp_extract(text, pattern, day))
        found = found.when(text.rlike(pattern), F.concat(date, rest))
    return found


def _iso_numbers(text: Column, date_format: DateFormat) -> Column:
    place = "$4-$1-$3" if date_format.order == MONTH_FIRST else "$4-$3-$1"
    if date_format.order == YEAR_FIRST:
        return F.regexp_replace(text, r"^(\d{4})([/.-])(\d{1,2})\2(\d{1,2})", "$1-$3-$4")
    if date_format.short_years:  # of 1969 to 2068
        for century, years in (("19", "69|[7-9]\\d"), ("20", "[0-6]\\d")):
            text = F.regexp_replace(text, rf"^(\d{{1,2}})([/.-])(\d{{1,2}})\2({years})(?!\d)", place.replace("$4", century + "$4"))
        return text
    return F.regexp_replace(text, r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})", place)


def parse_invoice_ts(text: Column, date_format: DateFormat = DateFormat()) -> Column:
    """A date with or without a time as a zone-free timestamp; NULL if it isn't one in the format."""
    text = F.trim(text)
    iso = _iso_named(text) if date_format.order == NAMED else _iso_numbers(text, date_format)
    if not date_format.twelve_hours:
        return iso.try_cast("timestamp_ntz")
    # The half of the day behind a mark, for which a text has another control character; without a branch, so that the pattern is looked for once.
    marked = F.regexp_replace(F.translate(iso, _MARK, "\u0002"), _TWELVE, f"$1 $2$3{_MARK}$4")
    clock = F.substring_index(marked, _MARK, 1).try_cast("timestamp_ntz")
    half = F.try_element_at(F.split(marked, _MARK), F.lit(2))
    late = (F.lower(F.substring(half, 1, 1)) == "p").cast("int")
    return F.timestamp_add("HOUR", 12 * (late - (F.hour(clock) == 12).cast("int")), clock)


def mean_month_offset(cohort_month: Column, activity_month: Column) -> Column:
    """Days between two month starts over the mean month length, truncated.

    This folds some neighbouring months together (February -> March is offset 0).
    """
    return (F.datediff(activity_month, cohort_month) / F.lit(DAYS_PER_MONTH)).cast("int")


def calendar_month_offset(cohort_month: Column, activity_month: Column) -> Column:
    """Whole calendar months between two month starts."""
    years = F.year(activity_month) - F.year(cohort_month)
    return years * 12 + F.month(activity_month) - F.month(cohort_month)
