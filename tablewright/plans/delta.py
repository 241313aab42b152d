"""Incremental extraction: bounds of the window, and the filters they make."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping as Params
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.dates import high_date, ntz
from tablewright.functions.spelling import expression

# Fixed value: format of the bounds handed to a run.
_RUN_FORMAT = "%d-%b-%Y %H:%M:%S"

LOWER_PARAMETER = "@LOWER_DATE_BOUND"
UPPER_PARAMETER = "@UPPER_DATE_BOUND"


def _run_bound(text: str, fraction: str = "") -> datetime:
    text = text.strip()
    if not re.search(r"\d:\d", text):
        text += " 00:00:00"
    if "." not in text and fraction:
        text += fraction
    return datetime.strptime(text, _RUN_FORMAT + (".%f" if "." in text else ""))


def _midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def lower_bound(text: str, as_of: datetime, params: Params[str, str] | None = None) -> Column:
    """The lower bound a token, a run parameter or an SQL expression stands for.

    Tokens are worked out here, so that they reach the scan as literals and can
    be pushed down. A week starts on Monday.
    """
    today = _midnight(as_of)
    monday = today - timedelta(days=today.weekday())
    tokens = {
        "$TODAY": today,
        "$YESTERDAY": today - timedelta(days=1),
        "$THISWEEK": monday,
        "$LASTWEEK": monday - timedelta(days=7),
        "$THISMONTH": today.replace(day=1),
    }
    token = text.strip().upper()
    if token == LOWER_PARAMETER:
        return ntz(_run_bound(_parameter(params, "lower_date_bound")))
    return ntz(tokens[token]) if token in tokens else expression(text)


def _parameter(params: Params[str, str] | None, name: str) -> str:
    try:
        return (params or {})[name]
    except KeyError:
        raise ValueError(f"the load needs the run parameter {name!r}") from None


def delta_bounds(
    lower: str,
    upper_seconds: int | None,
    as_of: datetime,
    params: Params[str, str] | None = None,
) -> tuple[Column, Column | None]:
    """``(lower, upper)`` of an extraction window; no upper bound is ``None``.

    With the run parameter as lower bound, the upper one is a run parameter as
    well and reaches to the end of its second. Otherwise the window is
    ``upper_seconds`` long, where 0 stands for the high date.
    """
    lo = lower_bound(lower, as_of, params)
    if lower.strip().upper() == LOWER_PARAMETER:
        return lo, ntz(_run_bound(_parameter(params, "upper_date_bound"), ".999999"))
    if upper_seconds is None:
        return lo, None
    if upper_seconds < 0:
        raise ValueError("upper_bound must not be negative")
    if upper_seconds == 0:
        return lo, high_date()
    return lo, lo + F.make_dt_interval(secs=F.lit(upper_seconds))


def in_window(field: Column, lo: Column | None, hi: Column | None) -> Column:
    if lo is None:
        return field < hi
    return field >= lo if hi is None else (field >= lo) & (field < hi)


def day_of(column: str) -> str:
    """Name of the partition column that holds the days of a time column (see :mod:`tablewright.sinks.archive`)."""
    return f"{column}_day"


def days_of_window(df: DataFrame, field: str, lo: Column | None, hi: Column | None) -> Column | None:
    """The days of a window, when ``df`` is partitioned by the days of ``field``: Spark lists no others. Else None."""
    named = re.fullmatch(r"(?:(\w+)\.)?(\w+)", field.strip())
    if not named or day_of(named[2]) not in df.columns:
        return None
    day = F.col(f"{named[1]}.{day_of(named[2])}" if named[1] else day_of(named[2]))
    bounds = [day >= F.to_date(lo)] if lo is not None else []
    bounds += [day <= F.to_date(hi)] if hi is not None else []
    return reduce(operator.and_, bounds)


def delta_filter(df: DataFrame, field: str, lo: Column, hi: Column | None) -> DataFrame:
    """Rows with ``lo <= field < hi``; ``field`` is a column or an expression."""
    days = days_of_window(df, field, lo, hi)
    rows = df if days is None else df.where(days)
    return rows.where(in_window(expression(field), lo, hi))


def before(df: DataFrame, field: str, lo: Column) -> DataFrame:
    """The rows an extraction from ``lo`` on leaves out as already loaded."""
    return df.where(expression(field) < lo)
