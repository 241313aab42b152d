"""Parquet tables that can be replaced while they are read: create, append, replace, truncate.

The rows of a table lie in a folder ``v<n>`` below its path. A replacement writes the next folder; it counts as soon as
Spark's own commit has marked it with ``_SUCCESS``, which is one step: readers take the finished folder with
the highest number and change nothing, so they see the old rows or the new ones, and a replacement that fails or breaks off
leaves the table as it was. The folder before stays for those who still read it, and goes with the next replacement.
One writer at a time is assumed. A folder of Parquet files without such folders is a table, too, until it is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.operators.projection import conform
from tablewright.plans.mapping import Disposition
from tablewright.session import filesystem

_FOLDER = re.compile(r"v(\d+)")
#: Column of tables that are kept by key (see :mod:`tablewright.sinks.keyed`), which is no part of their rows.
BUCKET_COLUMN = re.compile(r"bucket_of_(\d+)")


def _names(spark: SparkSession, path: str) -> list[str]:
    target, system = filesystem(spark, path)
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def finished(spark: SparkSession, folder: str) -> bool:
    mark, system = filesystem(spark, f"{folder}/_SUCCESS")
    return system.exists(mark)


def _numbers(names: Sequence[str]) -> list[int]:
    return sorted(int(found[1]) for name in names if (found := _FOLDER.fullmatch(name)))


def rows_folder(spark: SparkSession, path: str) -> str | None:
    """Where the rows of the table are; None if there is no table."""
    path, names = path.rstrip("/"), _names(spark, path)
    for n in reversed(_numbers(names)):
        if finished(spark, f"{path}/v{n}"):
            return f"{path}/v{n}"
    plain = any(not _FOLDER.fullmatch(name) and (name[:1] not in "_." or name == "_SUCCESS") for name in names)
    return path if plain else None


def exists(spark: SparkSession, path: str) -> bool:
    return rows_folder(spark, path) is not None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as it was last replaced or added to."""
    found = spark.read.parquet(rows_folder(spark, path) or path)
    return found.drop(*[c for c in found.columns if BUCKET_COLUMN.fullmatch(c)])


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write the table anew, schema and rows; it may be read in ``df``. Returns where the rows are."""
    spark, path = df.sparkSession, path.rstrip("/")
    before, names = rows_folder(spark, path), _names(spark, path)
    folder = f"{path}/v{max(_numbers(names), default=0) + 1}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder)
    if not finished(spark, folder):
        raise OSError(f"Spark has not marked {folder} as finished, so no reader would see it")
    for name in names:
        if before == path or f"{path}/{name}" == before:
            continue  # those who read the table now need them
        old, system = filesystem(spark, f"{path}/{name}")
        system.delete(old, True)
    return folder


def create_target(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty table unless there is one; whether it was created."""
    if exists(spark, path):
        return False
    replace(spark.createDataFrame([], schema), path)
    return True


def write(df: DataFrame, path: str, disposition: str | Disposition = Disposition.TRUNCATE) -> None:
    """Write a table the way its disposition says.

    Append adds rows and truncate replaces them; both keep the schema of an
    existing table. Transient replaces schema and rows.
    """
    disposition = Disposition.of(disposition)
    spark = df.sparkSession
    if disposition is Disposition.DELETE:
        truncate(spark, path)
        return
    folder = rows_folder(spark, path)
    if disposition is not Disposition.TRANSIENT and folder:
        df = conform(df, read(spark, path).schema)
    if disposition is Disposition.APPEND and folder:
        df.write.mode("append").parquet(folder)
    else:
        replace(df, path)


def truncate(spark: SparkSession, path: str) -> None:
    """Remove all rows of a table and keep its schema."""
    schema = read(spark, path).schema
    replace(spark.createDataFrame([], schema), path)
