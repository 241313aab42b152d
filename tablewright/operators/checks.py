"""Data checks. Each returns one row: ``check``, ``result``, ``n_failed``."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.dates import HIGH_DATE, ntz
from tablewright.operators.history import open_rows
from tablewright.plans.mapping import EFFECTIVE_TO, Mapping, TargetType
from tablewright.session import stage

ROW_COUNT = "row_count"
DUPLICATES = "duplicate_records"
OPEN_HISTORY = "open_history_items"
NEW_VALUE = "new_value"
REQUIRED = "required_fields"
QUERY = "query"


def _verdict(name: str, failed: Column, passed: Column | None = None) -> list[Column]:
    failed = F.coalesce(failed, F.lit(0)).cast("long")
    return [
        F.lit(name).alias("check"),
        (failed == 0 if passed is None else passed).alias("result"),
        failed.alias("n_failed"),
    ]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often. Counted before the shuffle."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_times"))
    return counted.where(F.col("_times") > 1).withColumnRenamed("_times", "n")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def check_row_count(df: DataFrame) -> DataFrame:
    """Passes when there is a row."""
    empty = (F.count("*") == 0).cast("long")
    return df.agg(*_verdict(ROW_COUNT, empty))


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Passes when no key occurs twice; ``n_failed`` counts keys."""
    return duplicate_keys(df, keys).agg(*_verdict(DUPLICATES, F.count("*")))


def check_open_history(df: DataFrame, hk: Sequence[str]) -> DataFrame:
    """Passes when no history key has two open rows."""
    return duplicate_keys(open_rows(df), hk).agg(*_verdict(OPEN_HISTORY, F.count("*")))


def new_values(
    df: DataFrame, check_field: str, date_field: str, now: str | datetime | Column
) -> DataFrame:
    """Values seen after the day before the last date, but never up to that day.

    Dates from ``now`` on do not count for the last date. First and last day of a
    value are aggregated before the shuffle; the boundary is a scalar subquery.
    """
    dated = df.select(F.expr(check_field).alias("value"), F.expr(date_field).alias("at"))
    last = dated.where(F.col("at") < ntz(now)).agg(F.to_date(F.max("at") - F.expr("interval 1 day")))
    boundary = last.scalar()
    span = (
        dated.where(F.col("at").isNotNull())
        .groupBy("value")
        .agg(F.to_date(F.min("at")).alias("first"), F.to_date(F.max("at")).alias("last"))
    )
    unseen = F.col("value").isNull() | (F.col("first") > boundary)
    return span.where((F.col("last") > boundary) & unseen).select("value", "first")


def check_new_value(
    df: DataFrame, check_field: str, date_field: str, now: str | datetime | Column
) -> DataFrame:
    """Passes when no new value has appeared in the last day of data."""
    return new_values(df, check_field, date_field, now).agg(*_verdict(NEW_VALUE, F.count("*")))


def check_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Passes when declared columns are there with their types, and required ones filled.

    ``n_failed`` counts null values in required fields, plus one for each column
    that is missing or of another type. One pass over the table.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    wrong = sum(1 for f in schema.fields if not _same_type(present.get(f.name), f.dataType))
    nulls = [
        F.count_if(F.col(f"`{f.name}`").isNull())
        for f in schema.fields
        if not f.nullable and f.name in present
    ]
    return df.agg(*_verdict(REQUIRED, reduce(operator.add, nulls, F.lit(wrong))))


def _same_type(found: T.DataType | None, declared: T.DataType) -> bool:
    """Equal but for nullability, which files do not keep."""
    return found is not None and found.simpleString() == declared.simpleString()


def _holds(field: T.StructField) -> Column:
    """Whether a value counts as true: not false, zero, empty or null."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        held = column
    elif isinstance(field.dataType, T.NumericType):
        held = column != 0
    elif isinstance(field.dataType, T.StringType):
        held = F.length(column) > 0
    else:
        held = column.isNotNull()
    return F.coalesce(held, F.lit(False))


def check_query(result: DataFrame, name: str = QUERY) -> DataFrame:
    """Verdict of a check written as a query: all values of its first row must hold.

    A count passes when it is not zero, a flag when it is true. Without a row,
    the check fails. ``n_failed`` counts the values that do not hold.
    """
    failed = [(~_holds(f)).cast("long") for f in result.schema.fields]
    per_row = result.limit(1).select(reduce(operator.add, failed).alias("n"))
    return per_row.agg(*_verdict(name, F.coalesce(F.sum("n"), F.lit(1))))


def _is_open(df: DataFrame) -> Column:
    return F.col(EFFECTIVE_TO) == F.lit(HIGH_DATE).cast(df.schema[EFFECTIVE_TO].dataType)


def _keyed_checks(df: DataFrame, pk: Sequence[str], hk: Sequence[str] = ()) -> DataFrame:
    """Row count, duplicates and, with a history key that is part of the primary key, open rows.

    The table is read once: counts by primary key are summed up by history key.
    """
    opened = F.count_if(_is_open(df)) if hk else F.lit(0)
    keyed = df.groupBy(*pk).agg(F.count("*").alias("_times"), opened.alias("_open"))
    found = {ROW_COUNT: F.count("*") == 0, DUPLICATES: F.count_if(F.col("_times") > 1)}
    if hk:
        keyed = keyed.groupBy(*hk).agg(
            F.count_if(F.col("_times") > 1).alias("_twice"),
            F.sum("_open").alias("_open"),
        )
        found = {
            ROW_COUNT: F.count("*") == 0,
            DUPLICATES: F.coalesce(F.sum("_twice"), F.lit(0)),
            OPEN_HISTORY: F.count_if(F.col("_open") > 1),
        }
    totals = keyed.agg(*[value.cast("long").alias(name) for name, value in found.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n_failed")) for c in found])
    return totals.select(F.inline(pairs)).select(
        "check", (F.col("n_failed") == 0).alias("result"), "n_failed"
    )


def check_suite(
    df: DataFrame,
    name: str,
    pk: Sequence[str] = (),
    hk: Sequence[str] = (),
    target_type: TargetType = TargetType.TYPE1,
    blocked: bool = False,
) -> DataFrame:
    """The checks every loaded table gets, as rows ``table, check, result, n_failed``.

    Row count always; duplicates when there is a primary key; open rows when
    there is one and the target is a history. Blocked, there are none.
    """
    history = bool(pk and hk) and target_type is TargetType.HISTORY
    within = history and set(hk) <= set(pk)
    if history and not within:  # read by two aggregations, and often the result of a long plan
        df = stage(df.select(*dict.fromkeys([*pk, *hk, EFFECTIVE_TO])), "checked")
    checks = _keyed_checks(df, pk, hk if within else ()) if pk else check_row_count(df)
    if history and not within:
        checks = checks.unionByName(check_open_history(df, hk))
    if blocked:
        checks = checks.limit(0)
    return checks.select(F.lit(name).alias("table"), "check", "result", "n_failed")


def check_mapping(df: DataFrame, mapping: Mapping) -> DataFrame:
    """The check suite of a loaded target, as its mapping asks for it."""
    return check_suite(
        df,
        mapping.target,
        mapping.primary_keys,
        mapping.history_keys,
        mapping.target_type,
        mapping.block_data_check,
    )
