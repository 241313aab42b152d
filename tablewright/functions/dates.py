"""Timestamps: literals, the open-ended date, dates in file names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end date carried by rows of a history that are still open.
HIGH_DATE = "2999-12-31 23:59:59"

# The date and time patterns looked for in file names.
_SEP = "[-_.]?"
_YEAR = "(2[0-9]{3})"
_MONTH = "([01][0-9]|JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)"
_DAY = "([0-3][0-9])"
_TIME = f"(?:([01][0-9]|2[0-3]){_SEP}([0-5][0-9]))?"
_YEAR_FIRST = f"(?i){_YEAR}{_SEP}{_MONTH}{_SEP}{_DAY}{_SEP}{_TIME}"
_DAY_FIRST = f"(?i){_DAY}{_SEP}{_MONTH}{_SEP}{_YEAR}{_SEP}{_TIME}"
_MONTH_NAMES = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def ntz(value: str | datetime | Column) -> Column:
    """A ``timestamp_ntz`` column from text, a ``datetime`` or a column."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    if isinstance(value, str):
        value = F.lit(value)
    return value.cast("timestamp_ntz")


def high_date() -> Column:
    return ntz(HIGH_DATE)


def _month_number(text: Column) -> Column:
    by_name = F.array_position(F.array(*[F.lit(name) for name in _MONTH_NAMES]), F.upper(text))
    return F.when(F.length(text) == 3, by_name).otherwise(text.try_cast("int")).cast("int")


def _stamp(name: Column, pattern: str, year: int, month: int, day: int) -> Column:
    def part(group: int) -> Column:
        return F.regexp_extract(name, pattern, group)

    return F.try_make_timestamp_ntz(
        part(year).try_cast("int"),
        _month_number(part(month)),
        part(day).try_cast("int"),
        F.coalesce(part(4).try_cast("int"), F.lit(0)),
        F.coalesce(part(5).try_cast("int"), F.lit(0)),
        F.lit(0).cast("decimal(16,6)"),
    )


def file_date(name: Column) -> Column:
    """The date a file name carries, at midnight when it gives no time.

    ``YYYY MM DD [HH MI]`` is looked for first, then ``DD MM YYYY [HH MI]``, with
    optional ``-``, ``_`` or ``.`` between the parts and the month as a number or
    as JAN to DEC. Null when there is no date or it is not a calendar date.
    """
    year_first = _stamp(name, _YEAR_FIRST, 1, 2, 3)
    day_first = _stamp(name, _DAY_FIRST, 3, 2, 1)
    return F.when(F.regexp_like(name, F.lit(_YEAR_FIRST)), year_first).otherwise(day_first)
