"""Views over sources, and the user's own SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Parquet tables ``<folder>/<name>.parquet`` by name."""
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}.parquet") for n in names}


def register_sources(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """A view over every source; a table used under two names gets one view each."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def _identifiers(names: Sequence[str]) -> str:
    quoted = []
    for name in names:
        parts = [f"`{part.replace('`', '``')}`" for part in name.strip().split(".")]
        quoted.append(".".join(parts))
    return ", ".join(quoted)


def run_sql(
    spark: SparkSession,
    text: str,
    params: Mapping[str, Any] | None = None,
    columns: Mapping[str, Sequence[str]] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run SQL with parameters.

    ``:name`` takes a value, ``IDENTIFIER(:name)`` a table or column name. Lists
    of columns, which SQL has no parameters for, and frames stand in braces.
    """
    for name, listed in (columns or {}).items():
        text = text.replace("{" + name + "}", _identifiers(listed))
    return spark.sql(text, args=dict(params or {}), **dict(tables or {}))


def run_sql_file(spark: SparkSession, path: str, **given: Any) -> DataFrame:
    """Run the SQL in a file; parameters as for :func:`run_sql`."""
    with open(path, encoding="utf-8") as file:
        return run_sql(spark, file.read(), **given)
