"""Single tasks of a job, from their JSON parameters.

When a task runs, and after which others, is left to the scheduler that calls
these functions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping as Config
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.operators import checks
from tablewright.operators.current import current_view, unnest
from tablewright.plans.config import mapping_from_config
from tablewright.plans.loads import publish_delta, run_load
from tablewright.plans.mapping import Disposition, OrderKey
from tablewright.sinks import tables as sink
from tablewright.sources.landing import read_landing
from tablewright.sources.schema import read_definition
from tablewright.sources.sql import run_sql, run_sql_file

#: An archive, and maybe one of its arrays under a name.
_FROM = re.compile(r"(?i)\s*([\w.$-]+)\s*(?:,\s*unnest\(\s*(\w+)\s*\)\s*(?:as\s+)?(\w+)\s*)?")


def _names(given: str | list[str] | None) -> list[str]:
    """Names from a list, or from text with commas between them."""
    parts = given.split(",") if isinstance(given, str) else given or []
    return [p.strip() for p in parts if p.strip()]


def load_files(
    spark: SparkSession, parameters: Config[str, Any], folder: str, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of a task that loads landed files.

    ``source_objects`` are names or patterns under ``folder``; the schema is the
    one of the definition file ``schema_object`` unless given.
    """
    schema = schema or read_definition(parameters["schema_object"])
    loaded = None
    for name in parameters["source_objects"]:
        rows = read_landing(
            spark,
            f"{folder.rstrip('/')}/{name}",
            schema,
            fmt=parameters.get("source_format"),
            sep=parameters.get("field_delimiter", ","),
            skip_rows=int(parameters.get("skip_leading_rows", 1)),
        )
        loaded = rows if loaded is None else loaded.unionByName(rows)
    if loaded is None:
        raise ValueError("the task names no source objects")
    return loaded


def _user_sql(spark: SparkSession, parameters: Config[str, Any], tables: Config[str, DataFrame]) -> DataFrame:
    """The result of a task's own SQL, given as text or as the path of a file.

    Lists among its parameters are lists of columns.
    """
    given = parameters.get("params") or {}
    columns = {k: v for k, v in given.items() if isinstance(v, (list, tuple))}
    values = {k: v for k, v in given.items() if k not in columns}
    text = parameters["sql"]
    run = run_sql_file if text.strip().lower().endswith(".sql") else run_sql
    used = {name: df for name, df in tables.items() if "{" + name + "}" in text or run is run_sql_file}
    return run(spark, text, params=values, columns=columns, tables=used)


def build_table(
    spark: SparkSession,
    parameters: Config[str, Any],
    sources: Config[str, DataFrame],
    run_ts: str | datetime,
    target: DataFrame | None = None,
    as_of: datetime | None = None,
    params: Config[str, str] | None = None,
) -> DataFrame:
    """The new state of the target of a table-building task: by its SQL, or its mapping."""
    if parameters.get("sql"):
        return _user_sql(spark, parameters, sources)
    return run_load(mapping_from_config(parameters), sources, run_ts, target, as_of, params)


def current_table(parameters: Config[str, Any], archives: Config[str, DataFrame]) -> DataFrame:
    """The current rows of an archive, as a task's ``params`` ask for them.

    ``FROM`` names the archive, and may name one of its arrays too (``archive, unnest(array) name``), whose elements
    then become columns. Of each ``KEY`` the row of the latest file stays, without the lineage and the columns of
    ``EXCLUDE``. Columns in ``TIE_BREAK``, the highest value first, decide between rows of one file and load.
    """
    given = parameters["params"]
    found = _FROM.fullmatch(given["FROM"])
    if not found:
        raise ValueError(f"cannot read FROM {given['FROM']!r}")
    name, array, alias = found.groups()
    df, exclude = archives[name], _names(given.get("EXCLUDE"))
    if array:
        df = unnest(df, array, alias)
        if isinstance(df.schema[alias].dataType, T.StructType):
            exclude.append(alias)
    tie_break = [OrderKey(c, desc=True) for c in _names(given.get("TIE_BREAK"))]
    return current_view(df, _names(given["KEY"]), exclude=exclude, tie_break=tie_break)


def run_build(
    spark: SparkSession,
    parameters: Config[str, Any],
    sources: Config[str, DataFrame],
    path: str,
    run_ts: str | datetime,
    as_of: datetime | None = None,
    params: Config[str, str] | None = None,
) -> DataFrame:
    """A table-building task from start to finish: build, write to ``path``, check; returns the verdicts.

    A load with a delta merges into the table at ``path``, which then lies in buckets by key: only those that the window
    touches are read and written. A mapping gets the checks that its keys and type ask for, a
    table by SQL the row count. There are no verdicts with ``block_data_check``, and none on a table that was emptied.
    """
    by_sql = bool(parameters.get("sql"))
    mapping = None if by_sql else mapping_from_config(parameters)
    disposition = Disposition.of(parameters.get("write_disposition"))
    if disposition is Disposition.DELETE:
        sink.truncate(spark, path)
        return checks.check_suite(sink.read(spark, path), parameters["destination_table"], blocked=True)
    merged = mapping is not None and mapping.delta is not None and disposition is not Disposition.TRANSIENT
    if merged:
        if as_of is None:
            raise ValueError("a load with a delta needs an as-of date")
        publish_delta(path, mapping, sources, as_of, run_ts, params)
    else:
        sink.write(build_table(spark, parameters, sources, run_ts), path, disposition)
    written = sink.read(spark, path)
    if mapping is not None:
        return checks.check_mapping(written, mapping)
    return checks.check_suite(written, parameters["destination_table"], blocked=bool(parameters.get("block_data_check")))


def check_table(
    spark: SparkSession, parameters: Config[str, Any], tables: Config[str, DataFrame], now: str | datetime
) -> DataFrame:
    """The verdict of a check task: its SQL, or a check by name on a table.

    Named checks take the table from ``FROM``, key columns from ``KEY``, and for
    new values the fields ``CHECK_FIELD`` and ``DATE_FIELD``.
    """
    if parameters.get("sql"):
        return checks.check_query(_user_sql(spark, parameters, tables))
    given = parameters.get("params") or {}
    df, key = tables[given["FROM"]], _names(given.get("KEY"))
    kind = parameters["check"]
    if kind == checks.ROW_COUNT:
        return checks.check_row_count(df)
    if kind == checks.DUPLICATES:
        return checks.check_duplicates(df, key)
    if kind == checks.OPEN_HISTORY:
        return checks.check_open_history(df, key)
    if kind == checks.NEW_VALUE:
        return checks.check_new_value(df, given["CHECK_FIELD"], given["DATE_FIELD"], now)
    raise ValueError(f"unknown check {kind!r}")
