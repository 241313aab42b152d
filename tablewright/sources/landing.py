"""Landed files: JSON, CSV and columnar files under a declared schema."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.dates import file_date

CORRUPT = "_corrupt_record"


def read_json(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    multi_line: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON objects, one per line, or one per file with ``multi_line``.

    A malformed object fails the read, unless it is kept: its text then stands
    in ``_corrupt_record`` and its other columns are null.
    """
    reader = spark.read.option("multiLine", multi_line)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(schema).json(paths)


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    skip_rows: int = 1,
) -> DataFrame:
    """Delimited files without their first ``skip_rows`` lines.

    One line or none to skip is what the CSV reader can do. For more, the lines
    are read as text: only a file's first block can hold lines to skip, and it
    is only there that lines are numbered, so files stay splittable.
    """
    if skip_rows <= 1:
        reader = spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST")
        return reader.option("header", skip_rows == 1).option("enforceSchema", True).csv(paths)
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") == 0).alias("leading"),
        F.monotonically_increasing_id().alias("line"),
    )
    order = Window.partitionBy("path").orderBy("line")
    leading = lines.where("leading").withColumn("nth", F.row_number().over(order))
    kept = leading.where(F.col("nth") > skip_rows).select("value")
    kept = kept.unionByName(lines.where(~F.col("leading")).select("value"))
    kept = kept.where(F.length(F.trim("value")) > 0)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", ddl, {"sep": sep, "mode": "FAILFAST"})
    return kept.select(parsed.alias("row")).select("row.*")


def source_format(path: str) -> str:
    """The format a file's extension stands for."""
    extension = os.path.splitext(path)[1].lstrip(".").lower()
    if not extension:
        raise ValueError(f"cannot tell the format of {path!r}; name it")
    return extension


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str | None = None,
    sep: str = ",",
    skip_rows: int = 1,
) -> DataFrame:
    """Landed files of the named format, else of the one of their extension."""
    fmt = (fmt or source_format(path)).lower()
    if fmt in ("json", "newline_delimited_json"):
        return read_json(spark, path, schema)
    if fmt == "csv":
        return read_csv(spark, path, schema, sep, skip_rows)
    return spark.read.schema(schema).format(fmt).load(path)


def stamp_lineage(
    df: DataFrame, file_name: Column | None = None, load_dt: Column | None = None
) -> DataFrame:
    """Add ``file_name``, ``file_dt`` and ``load_dt`` to rows that lack them.

    ``df`` is a file read, in batch or as a stream. Unless told otherwise, a row
    was loaded when its file was last modified. The file date is the one in the
    file name, else the load time. Null counts as lacking.
    """
    name = F.col("_metadata.file_name") if file_name is None else file_name
    loaded = F.col("_metadata.file_modification_time") if load_dt is None else load_dt
    loaded = loaded.cast("timestamp")
    dated = F.coalesce(file_date(name).cast("timestamp"), loaded)
    columns = {}
    for column, value in {"file_name": name, "file_dt": dated, "load_dt": loaded}.items():
        if column in df.columns:
            given = F.col(column)
            value = F.coalesce(given, value.cast(df.schema[column].dataType))
        columns[column] = value
    return df.withColumns(columns)


def route(df: DataFrame, token: str, file_name: str = "file_name") -> DataFrame:
    """Rows from files whose name has ``token`` between underscores."""
    return df.where(F.array_contains(F.split(F.col(file_name), "_"), token))
