"""Keyed changes to a target table, as DataFrames of its new state.

Parquet tables cannot be updated in place, so every function returns the whole
new table; ``sinks`` puts it where it belongs. A null key matches nothing, as in
SQL: such stage rows are always new.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping as Columns
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.dates import ntz
from tablewright.operators.projection import conform
from tablewright.operators.sizing import broadcast_if_small, fits_broadcast
from tablewright.plans.mapping import AUDIT, MODIFIED

NEW, EXISTING = 1, 2
_SPREAD = "_spread"


def any_null(keys: Sequence[str]) -> Column:
    return reduce(operator.or_, [F.col(f"`{k}`").isNull() for k in keys])


def _spread_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a column that is 0, or for rows without a full key, spreads them evenly.

    They have no partner to meet, and would all be shuffled to one task.
    """
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() != "map"]
    return df.withColumn(_SPREAD, F.when(any_null(keys), F.xxhash64(*plain)).otherwise(F.lit(0)))


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The rows of ``df`` with ``_spread``; fails if two of them share a full key.

    Hash-partitioned by key, so a join on the key after it does not shuffle again.
    """
    keyed = _spread_nulls(df, keys)
    columns = [F.col(f"`{k}`") for k in keys]
    window = Window.partitionBy(*columns, _SPREAD).orderBy(*columns)
    message = F.concat(
        F.lit(f"{what} has more than one row for key "), F.to_json(F.struct(*columns))
    )
    repeated = (F.row_number().over(window) > 1) & ~any_null(keys)
    checked = keyed.withColumn("_unique", F.when(repeated, F.raise_error(message).cast("int")).otherwise(1))
    # As a filter the check stays, whichever columns are read in the end.
    return checked.where(F.col("_unique") == 1).drop("_unique")


def _on(left: str, right: str, keys: Sequence[str], spread: bool = False) -> Column:
    names = [*keys, _SPREAD] if spread else keys
    return reduce(operator.and_, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in names])


def _existing_keys(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], small: bool | None = None
) -> DataFrame:
    """Keys of the stage that the target holds.

    A small list of keys is broadcast, so that the target's keys are only
    scanned. It is measured, unless the stage is known to be ``small``.
    """
    wanted = stage.select(*keys).distinct()
    wanted = F.broadcast(wanted) if small else broadcast_if_small(wanted)
    return target.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def classify(stage: DataFrame, target: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Add ``row_action`` to the stage: 1 for a key the target lacks, 2 for one it has."""
    known = _existing_keys(target, stage, pk).withColumn(_SPREAD, F.lit(0)).alias("known")
    rows = _spread_nulls(stage, pk).alias("stage")
    joined = rows.join(known, _on("stage", "known", pk, spread=True), "left")
    action = F.when(F.col(f"known.{_SPREAD}").isNull(), F.lit(NEW)).otherwise(F.lit(EXISTING))
    return joined.select(*[F.col(f"stage.{c}") for c in stage.columns], action.alias("row_action"))


def insert_new(target: DataFrame, stage: DataFrame, pk: Sequence[str]) -> DataFrame:
    """The target with the stage rows whose key it lacks appended."""
    return union_append(target, conform(new_rows(target, stage, pk), target.schema))


def new_rows(target: DataFrame, stage: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Stage rows whose key the target lacks."""
    return _without(_spread_nulls(stage, pk), _existing_keys(target, stage, pk), pk).drop(_SPREAD)


def _without(spread: DataFrame, existing: DataFrame, pk: Sequence[str]) -> DataFrame:
    known = existing.withColumn(_SPREAD, F.lit(0)).alias("known")
    return spread.alias("stage").join(known, _on("stage", "known", pk, spread=True), "left_anti")


def union_append(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, matched by column name, duplicates kept."""
    return first.unionByName(second)


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    set_exprs: Columns[str, str | Column],
    where: Column | None = None,
) -> DataFrame:
    """The target with columns set, in rows that have a partner in the source.

    Expressions and ``where`` refer to both sides as ``trg`` and ``src``. The
    source must be unique on the key. A small source is broadcast; the target is
    then only scanned.
    """
    unique = require_unique(source, on, "the source of the update")
    return _update(target, unique, on, set_exprs, fits_broadcast(source), where)


def _update(
    target: DataFrame,
    spread: DataFrame,
    on: Sequence[str],
    set_exprs: Columns[str, str | Column],
    small: bool,
    where: Column | None = None,
) -> DataFrame:
    rows = _spread_nulls(target, on).alias("trg")
    source = (F.broadcast(spread) if small else spread).alias("src")
    joined = rows.join(source, _on("trg", "src", on, spread=True), "left")
    hit = F.col(f"src.{_SPREAD}").isNotNull()
    if where is not None:
        hit = hit & where
    columns = []
    for field in target.schema.fields:
        old = F.col(f"trg.{field.name}")
        if field.name in set_exprs:
            new = set_exprs[field.name]
            new = F.expr(new) if isinstance(new, str) else new
            old = F.when(hit, new.cast(field.dataType)).otherwise(old)
        columns.append(old.alias(field.name))
    return joined.select(*columns)


def upsert(
    target: DataFrame,
    stage: DataFrame,
    pk: Sequence[str],
    run_ts: str | datetime | Column,
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Insert stage rows with new keys and update the rows of known ones.

    An update sets the columns ``update`` (all that are not key, by default) and
    the time of modification; an insert sets both audit times. Rows of the
    target without a partner stay as they are. The stage must be unique on the
    key; two rows with one key fail the job.
    """
    if not pk:
        raise ValueError("an upsert needs a primary key")
    stage = stage.drop(*AUDIT)
    if update is None:
        update = [c for c in stage.columns if c not in pk]
    sets: dict[str, str | Column] = {c: F.col(f"src.{c}") for c in update if c in target.columns}
    if MODIFIED in target.columns:
        sets[MODIFIED] = ntz(run_ts)
    small = fits_broadcast(stage)
    updated = _update(target, _spread_nulls(stage, pk), pk, sets, small)
    # Every stage row passes the check here, before known keys are left out.
    unique = require_unique(stage, pk, "the stage of the upsert")
    added = _without(unique, _existing_keys(target, stage, pk, small or None), pk)
    for name in AUDIT:
        added = added.withColumn(name, ntz(run_ts))
    return union_append(updated, conform(added, target.schema))

