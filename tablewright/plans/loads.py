"""Loads of one target table: type 1 and type 2, full and incremental.

Each takes a :class:`Mapping` and the source frames by name, and returns the new
state of the target. Load time and as-of date are arguments, so a rerun gives
the same table.
"""

from __future__ import annotations

from collections.abc import Mapping as Named
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.filters import apply_where
from tablewright.operators.history import build_history
from tablewright.operators.joins import apply_joins
from tablewright.functions.dates import ntz
from tablewright.functions.spelling import expression
from tablewright.operators.projection import audit_order, conform, project, with_audit
from tablewright.operators.sizing import broadcast_if_small, null_safe_on
from tablewright.operators.upsert import require_unique, upsert
from tablewright.plans.delta import days_of_window, delta_bounds, in_window
from tablewright.plans.mapping import (
    AUDIT,
    CREATED,
    MODIFIED,
    Disposition,
    History,
    Mapping,
    OrderKey,
    TargetType,
)
from tablewright.session import stage as staged
from tablewright.sinks import keyed, tables
from tablewright.sinks.lookup import key_filter

#: Prefix of columns that a history load needs on its way only.
HIDDEN = "_hidden_"

Sources = Named[str, DataFrame]
Params = Named[str, str]


def joined_sources(mapping: Mapping, sources: Sources) -> DataFrame:
    """Driving table, joins and filter of a mapping, before its projection."""
    joined = apply_joins(sources[mapping.driving_table], mapping.joins, sources)
    return apply_where(joined, mapping.where)


def mapped_rows(mapping: Mapping, sources: Sources, within: Column | None = None) -> DataFrame:
    """The mapped columns of the source rows, restricted to ``within``."""
    rows = joined_sources(mapping, sources)
    rows = rows if within is None else rows.where(within)
    return project(rows, mapping.mapped)


def _audited(df: DataFrame, mapping: Mapping, run_ts, created: bool) -> DataFrame:
    df = with_audit(df, run_ts, created)
    return df.select(*[F.col(f"`{c}`") for c in audit_order(mapping.mapped, df.columns)])


def type1_full(
    mapping: Mapping, sources: Sources, run_ts: str | datetime, created: bool | None = None
) -> DataFrame:
    """Joined, filtered and mapped rows with the time of the load.

    The creation time is added for targets that are loaded incrementally later
    on, which is when the mapping has a delta unless ``created`` says otherwise.
    """
    created = mapping.delta is not None if created is None else created
    return _audited(mapped_rows(mapping, sources), mapping, run_ts, created)


def _window(mapping: Mapping, sources: Sources, lo: Column | None, hi: Column | None) -> Column:
    """The extraction window as a filter, and on the days of an archive that lies in days."""
    field = mapping.delta.field
    days = days_of_window(sources[mapping.driving_table], field, lo, hi)
    bounds = in_window(expression(field), lo, hi)
    return bounds if days is None else bounds & days


def delta_rows(
    mapping: Mapping, sources: Sources, as_of: datetime, params: Params | None = None
) -> DataFrame:
    """Mapped rows of the extraction window: a delta load before any merge."""
    lo, hi = delta_bounds(mapping.delta.lower_bound, mapping.delta.upper_bound, as_of, params)
    return mapped_rows(mapping, sources, _window(mapping, sources, lo, hi))


def type1_delta(
    mapping: Mapping,
    sources: Sources,
    target: DataFrame,
    as_of: datetime,
    run_ts: str | datetime,
    params: Params | None = None,
) -> DataFrame:
    """The target with the rows of the extraction window inserted or updated.

    The extracted rows are staged: the merge reads them more than once.
    """
    if not mapping.primary_keys:
        raise ValueError(f"the incremental load of {mapping.target} needs a primary key")
    stage = staged(delta_rows(mapping, sources, as_of, params), mapping.target)
    return upsert(target, stage, mapping.primary_keys, run_ts)


def _history_rows(
    mapping: Mapping, sources: Sources, within: Column | None = None, *extra: Column
) -> tuple[DataFrame, History]:
    """Mapped rows and their history, with order keys over sources as hidden columns."""
    if mapping.history is None:
        raise ValueError(f"the history load of {mapping.target} needs its history described")
    names = {f.target_name for f in mapping.mapped}
    order, hidden = [], []
    for position, key in enumerate(mapping.history.order):
        if key.expression in names:
            order.append(key)
        else:
            hidden.append(expression(key.expression).alias(f"{HIDDEN}{position}"))
            order.append(OrderKey(f"{HIDDEN}{position}", key.desc))
    rows = joined_sources(mapping, sources)
    rows = rows if within is None else rows.where(within)
    history = History(mapping.history.partition, mapping.history.driving, tuple(order))
    return project(rows, mapping.mapped, [*hidden, *extra]), history


def _without_hidden(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(HIDDEN)])


def scd2_full(
    mapping: Mapping,
    sources: Sources,
    run_ts: str | datetime,
    created: bool | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """The history of all source rows: a row per change, valid until the next one."""
    rows, history = _history_rows(mapping, sources)
    built = _without_hidden(build_history(rows, history, rows_per_task))
    created = mapping.delta is not None if created is None else created
    return _audited(built, mapping, run_ts, created)


def touched_keys(mapping: Mapping, sources: Sources, as_of: datetime, params: Params | None = None) -> DataFrame:
    """The history keys with a row in the extraction window, staged."""
    lo, hi = delta_bounds(mapping.delta.lower_bound, mapping.delta.upper_bound, as_of, params)
    rows = mapped_rows(mapping, sources, _window(mapping, sources, lo, hi))
    return staged(rows.select(*mapping.history_keys).distinct(), "touched")


def scd2_delta(
    mapping: Mapping,
    sources: Sources,
    target: DataFrame,
    as_of: datetime,
    run_ts: str | datetime,
    params: Params | None = None,
    rows_per_task: int | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """The history with the rows of the extraction window worked in.

    Keys with a row in the window are computed anew from all of their source
    rows up to its end, and the new rows take the place of all that the target
    has of the key. So a row that repeats the value before the window is no
    change, and one that arrives late can also take known rows out. Rows that
    were there keep their time of creation. Null is a key like any other.
    ``touched`` are those keys, if they have been staged already.
    """
    keys, pk, delta = mapping.history_keys, mapping.primary_keys, mapping.delta
    if not keys or not pk:
        raise ValueError(f"the incremental load of {mapping.target} needs history and primary keys")
    hi = delta_bounds(delta.lower_bound, delta.upper_bound, as_of, params)[1]
    # Only the window's end bounds what a key is computed from.
    until_end = None if hi is None else _window(mapping, sources, None, hi)
    # A small list of keys is broadcast, and the source is then not shuffled to find them.
    touched = touched_keys(mapping, sources, as_of, params) if touched is None else touched
    few = key_filter(touched, keys)  # a very small one narrows the scan of the source as well
    touched = broadcast_if_small(touched)

    def of_touched(df: DataFrame, how: str) -> DataFrame:
        if few is not None and how == "left_semi":
            df = df.where(few)
        return df.alias("rows").join(touched.alias("touched"), null_safe_on("rows", "touched", keys), how)

    rows, history = _history_rows(mapping, sources, until_end)
    built = _without_hidden(build_history(of_touched(rows, "left_semi"), history, rows_per_task))
    built = staged(built, mapping.target)
    new = require_unique(built, pk, f"the history of {mapping.target}").select(*built.columns)
    if CREATED in target.columns:
        known = of_touched(target, "left_semi").groupBy(*pk).agg(F.min(CREATED).alias("_known"))
        joined = new.alias("new").join(known.alias("known"), null_safe_on("new", "known", pk), "left")
        new = joined.select("new.*", F.coalesce("_known", ntz(run_ts)).alias(CREATED))
    new = new.withColumn(MODIFIED, ntz(run_ts))
    return of_touched(target, "left_anti").unionByName(conform(new, target.schema))


def _empty_target(mapping: Mapping, sources: Sources, run_ts: str | datetime) -> DataFrame:
    """A table without rows, with the columns a full load would give it."""
    nothing = {name: df.limit(0) for name, df in sources.items()}
    load = scd2_full if mapping.target_type is TargetType.HISTORY else type1_full
    found = load(mapping, nothing, run_ts, created=True)
    return found.sparkSession.createDataFrame([], found.schema)


def publish_history(
    path: str,
    mapping: Mapping,
    sources: Sources,
    as_of: datetime,
    run_ts: str | datetime,
    params: Params | None = None,
    buckets: int | None = None,
) -> bool:
    """Work the extraction window into the history at ``path``, which lies in buckets by history key.

    Only the buckets that hold a touched key are read and written; the others keep their files. A table that is not
    there yet begins empty. Returns whether there was a change.
    """
    schema = _empty_target(mapping, sources, run_ts).schema
    keys = T.StructType([schema[k] for k in mapping.history_keys])
    touched = conform(touched_keys(mapping, sources, as_of, params), keys)

    def renew(state: DataFrame, touched: DataFrame) -> DataFrame:
        return scd2_delta(mapping, sources, state, as_of, run_ts, params, touched=touched)

    return keyed.change_buckets(path, touched, mapping.history_keys, renew, schema, buckets, null_keys=True)


def publish_delta(
    path: str,
    mapping: Mapping,
    sources: Sources,
    as_of: datetime,
    run_ts: str | datetime,
    params: Params | None = None,
    buckets: int | None = None,
) -> bool:
    """Merge the extraction window into the table at ``path``, touched buckets only; whether there was a change.

    A table without rows is created when there is none and the window is empty.
    """
    if mapping.target_type is TargetType.HISTORY:
        changed = publish_history(path, mapping, sources, as_of, run_ts, params, buckets)
    elif not mapping.primary_keys:
        raise ValueError(f"the incremental load of {mapping.target} needs a primary key")
    else:
        rows = delta_rows(mapping, sources, as_of, params)
        schema = _empty_target(mapping, sources, run_ts).schema
        changed = keyed.publish_upsert(path, rows, mapping.primary_keys, run_ts, schema, buckets)
    if not changed:
        empty = _empty_target(mapping, sources, run_ts)
        tables.create_target(empty.sparkSession, path, empty.schema)
    return changed


def run_load(
    mapping: Mapping,
    sources: Sources,
    run_ts: str | datetime,
    target: DataFrame | None = None,
    as_of: datetime | None = None,
    params: Params | None = None,
) -> DataFrame:
    """The new rows or state of a target, as its mapping describes the load.

    Transient tables are the mapped rows alone; with a delta, of its window. A
    load with a delta merges its window into ``target``, which is an empty table
    if there is none yet; without, it replaces it or, for the append
    disposition, adds to it. To load everything at first, leave the delta out.
    """
    disposition = mapping.disposition
    if disposition is Disposition.DELETE:
        if target is None:
            raise ValueError("truncating a table needs the table")
        return target.limit(0)
    if mapping.delta is not None and as_of is None:
        raise ValueError("a load with a delta needs an as-of date")
    if disposition is Disposition.TRANSIENT and mapping.target_type is TargetType.TYPE1:
        return mapped_rows(mapping, sources) if mapping.delta is None else delta_rows(
            mapping, sources, as_of, params
        )
    history = mapping.target_type is TargetType.HISTORY
    if mapping.delta is not None and disposition is not Disposition.TRANSIENT:
        if target is None:
            target = _empty_target(mapping, sources, run_ts)
        load = scd2_delta if history else type1_delta
        return load(mapping, sources, target, as_of, run_ts, params)
    full = (scd2_full if history else type1_full)(mapping, sources, run_ts)
    if disposition is Disposition.TRANSIENT:
        return full.drop(*AUDIT)
    if disposition is Disposition.APPEND and target is not None:
        return target.unionByName(full)
    return full
