"""Date parsing and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newscov.taxonomy import FRENCH_MONTHS

ENGLISH_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# Day and month first, year last: pattern, then month-first and day-first ISO forms.
_YEAR_LAST = r"^\s*(\d{1,2})[/-](\d{1,2})[/-](\d{4})(.*)$"
_YEAR_FIRST = r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})(.*)$"
_COMPACT = r"^\s*(\d{4})(\d{2})(\d{2})(\s.*)?$"
_SHORT_YEAR = r"^\s*(\d{1,2})[/-](\d{1,2})[/-](\d{2})(\s.*)?$"
_DAY_NAME = r"(?i)^\s*(\d{1,2})[\s-]+(\p{L}{3,9})\.?,?[\s-]+(\d{4})(\s.*)?$"
_NAME_DAY = r"(?i)^\s*(\p{L}{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})(\s.*)?$"
# Two-digit years from this one on are of the last century.
_LAST_CENTURY = 69


def _named_month(text: Column, pattern: str, day: int, name: int) -> Column:
    """ISO text of a date with an English month name or its beginning; null if it is none."""
    word = F.lower(F.regexp_extract(text, pattern, name))
    number = F.array_position(F.transform(F.array(*map(F.lit, ENGLISH_MONTHS)), lambda m: m.startswith(word)), F.lit(True))
    parts = [F.regexp_extract(text, pattern, 3), number.cast("string"), F.regexp_extract(text, pattern, day)]
    iso = F.concat(F.concat_ws("-", *parts), F.regexp_extract(text, pattern, 4))
    return F.when((word != "") & (number > 0), iso)


def parse_mixed(text: Column, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp from ISO, slashed, dashed or compact text or one with an English month name.

    Numbers are month-first unless that is no date. Anything else is tried against ``formats``
    and gives null if none fits. Casts come before format strings: a failed cast is a plain null,
    a failed format costs an exception per row.
    """
    rewrites = (
        (_YEAR_LAST, "$3-$1-$2$4"), (_YEAR_LAST, "$3-$2-$1$4"), (_YEAR_FIRST, "$1-$2-$3$4"), (_COMPACT, "$1-$2-$3$4"),
    )
    year = F.regexp_extract(text, _SHORT_YEAR, 3)
    century = F.when(year >= str(_LAST_CENTURY), "19").otherwise("20")
    # a compact date would pass the cast as a year of eight digits
    read = [F.when(~text.rlike(_COMPACT), text)]
    read += [F.when(text.rlike(pattern), F.regexp_replace(text, pattern, iso)) for pattern, iso in rewrites]
    for first, second in ((1, 2), (2, 1)):
        parts = [F.concat(century, year), F.regexp_extract(text, _SHORT_YEAR, first), F.regexp_extract(text, _SHORT_YEAR, second)]
        read.append(F.when(year != "", F.concat(F.concat_ws("-", *parts), F.regexp_extract(text, _SHORT_YEAR, 4))))
    read += [_named_month(text, _DAY_NAME, 1, 2), _named_month(text, _NAME_DAY, 2, 1)]
    read += [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*[value.try_cast("timestamp_ntz") for value in read])


def parse_date_part(text: Column) -> Column:
    """Date from the text before the first space; bad text gives null."""
    return F.substring_index(text, " ", 1).try_cast("date")


def period_start(date: Column, period: str) -> Column:
    """First day of the day, Monday-based week or month that holds ``date``."""
    day = date.cast("date")
    if period == "day":
        return day
    if period in ("week", "month"):
        return F.trunc(day, period)
    raise ValueError(f"unknown period: {period}")


def month_name(date: Column) -> Column:
    """French month name."""
    return F.try_element_at(F.array(*map(F.lit, FRENCH_MONTHS)), F.month(date))


def month_number(name: str) -> int:
    """Month number of a French month name."""
    return FRENCH_MONTHS.index(name) + 1
