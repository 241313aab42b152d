"""Type-2 histories: previous values, change detection, validity intervals."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.dates import HIGH_DATE
from tablewright.operators.windows import neighbours, spread_hot_keys, union_parts
from tablewright.plans.mapping import (
    EFFECTIVE_CSN,
    EFFECTIVE_FROM,
    EFFECTIVE_SEQ,
    EFFECTIVE_TO,
    History,
    OrderKey,
)

#: Order in which the rows of a key follow each other in a history.
EFFECTIVE_ORDER = (OrderKey(EFFECTIVE_FROM), OrderKey(EFFECTIVE_CSN), OrderKey(EFFECTIVE_SEQ))


def previous(column: str) -> str:
    return f"prev_{column}"


def _previous_values(
    df: DataFrame, partition: Sequence[str], order: Sequence[OrderKey], driving: Sequence[str]
) -> DataFrame:
    return neighbours(df, partition, order, {previous(c): F.col(f"`{c}`") for c in driving}, -1)


def history_stage(df: DataFrame, history: History, rows_per_task: int | None = None) -> DataFrame:
    """Mapped rows with the previous value of every driving column, ``prev_<name>``."""
    parts = spread_hot_keys(df, history.partition, history.order, rows_per_task)
    return union_parts([_previous_values(p, by, history.order, history.driving) for p, by in parts])


def cdc_filter(df: DataFrame, driving: Sequence[str], keep_previous: bool = False) -> DataFrame:
    """Rows in which any driving column differs from its previous value.

    Null is a value like any other here, so the first row of a key is kept
    unless all of its driving columns are null.
    """
    changed = [~F.col(f"`{c}`").eqNullSafe(F.col(f"`{previous(c)}`")) for c in driving]
    kept = df.where(reduce(operator.or_, changed))
    return kept if keep_previous else kept.drop(*[previous(c) for c in driving])


def _closed(df: DataFrame, partition: Sequence[str], order: Sequence[OrderKey]) -> DataFrame:
    until = F.lit(HIGH_DATE).cast(df.schema[EFFECTIVE_FROM].dataType)
    begins = {EFFECTIVE_TO: F.col(EFFECTIVE_FROM)}
    closed = neighbours(df, partition, order, begins, 1, until)
    names = [c for c in closed.columns if c != EFFECTIVE_TO]
    at = names.index(EFFECTIVE_SEQ) + 1 if EFFECTIVE_SEQ in names else len(names)
    return closed.select(*[F.col(f"`{c}`") for c in (*names[:at], EFFECTIVE_TO, *names[at:])])


def close_intervals(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[OrderKey] = EFFECTIVE_ORDER,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Set ``effective_to_dt`` to where the key's next row begins, else to the high date."""
    df = df.drop(EFFECTIVE_TO)
    parts = spread_hot_keys(df, partition, order, rows_per_task)
    return union_parts([_closed(p, by, order) for p, by in parts])


def build_history(df: DataFrame, history: History, rows_per_task: int | None = None) -> DataFrame:
    """Mapped rows to history rows: previous values, change detection, intervals.

    With one order throughout, both windows share a shuffle and a sort, and the
    segments of hot keys serve for both.
    """
    df = df.drop(EFFECTIVE_TO)
    order, partition = tuple(history.order), history.partition
    spread = spread_hot_keys(df, partition, order, rows_per_task)
    parts = []
    for part, by in spread:
        changed = cdc_filter(_previous_values(part, by, order, history.driving), history.driving)
        if order == EFFECTIVE_ORDER:
            changed = _closed(changed, by, order)
        parts.append(changed)
    done = union_parts(parts)
    if order == EFFECTIVE_ORDER:
        return done
    if len(spread) == 1:  # no hot keys, and there are fewer rows now
        return _closed(done, partition, EFFECTIVE_ORDER)
    return close_intervals(done, partition, rows_per_task=rows_per_task)


def open_rows(df: DataFrame) -> DataFrame:
    """The rows of a history that are still valid."""
    return df.where(F.col(EFFECTIVE_TO) == F.lit(HIGH_DATE).cast(df.schema[EFFECTIVE_TO].dataType))

