"""Tables that change by key: Parquet partitioned by a bucket of the key, of which a change overwrites the touched.

The number of buckets follows from the size of the table, ``BUCKET_BYTES`` of files each, and is part of the name of the
partition column (``bucket_of_16``), so nothing about the layout is kept elsewhere. A change reads the buckets of its
keys, stages their new rows in ``_change`` beside them, and writes those with Spark's dynamic partition overwrite: files of other buckets
stay as they are. Spark swaps the partitions one after the other; a change that breaks off in between is finished
from its staged rows by the next one. A table that has outgrown its buckets is written anew with more of them, as
:mod:`tablewright.sinks.tables` replaces tables, so readers see one layout or the other.

One writer at a time is assumed. Frames read before a change should not be computed after it: the files of touched buckets are gone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.projection import conform
from tablewright.operators.sizing import fits_broadcast
from tablewright.operators.upsert import any_null, upsert
from tablewright.plans.mapping import AUDIT
from tablewright.session import filesystem, fresh_path
from tablewright.sinks import tables

#: Files of a bucket, in bytes, when a table is written; at twice the mean the table gets more buckets.
BUCKET_BYTES = 1 << 30

_CHANGE = "_change"


def _bytes(spark: SparkSession, path: str) -> int:
    found, system = filesystem(spark, path)
    return system.getContentSummary(found).getLength()


def _delete(spark: SparkSession, path: str) -> None:
    found, system = filesystem(spark, path)
    system.delete(found, True)


def buckets_for(size: int) -> int:
    """How many buckets tables of ``size`` bytes have: a power of two."""
    return 1 << max(0, -(-size // BUCKET_BYTES) - 1).bit_length()


def bucket_of(df: DataFrame, pk: Sequence[str], buckets: int, null_keys: bool = False) -> Column:
    """Bucket by key. Rows without a full key match nothing, so the rest of the row spreads them, unless null is a key."""
    by_key = F.xxhash64(*[F.col(f"`{k}`") for k in pk])
    if not null_keys:
        # Audit times differ between a row that comes in and the same row in the table.
        plain = sorted(f.name for f in df.schema.fields if f.dataType.typeName() != "map" and f.name not in AUDIT)
        by_key = F.when(any_null(pk), F.xxhash64(*[F.col(f"`{c}`") for c in plain])).otherwise(by_key)
    return F.pmod(by_key, F.lit(buckets)).cast("int")


def layout(spark: SparkSession, folder: str) -> dict[str, list[int]]:
    """The bucket column of a folder, and the buckets that have files; empty for folders without."""
    path, system = filesystem(spark, folder)
    found: dict[str, list[int]] = {}
    for status in system.listStatus(path):
        column, _, bucket = status.getPath().getName().partition("=")
        if bucket and tables.BUCKET_COLUMN.fullmatch(column):
            found.setdefault(column, []).append(int(bucket))
    return found


def publish(
    df: DataFrame, path: str, pk: Sequence[str], buckets: int | None = None, null_keys: bool = False
) -> None:
    """Replace the table. It may be read in ``df``. The number of buckets is measured unless given."""
    spark = df.sparkSession
    staged = None
    if buckets is None:
        staged = fresh_path(spark, "publish")
        df.write.parquet(staged)
        df, buckets = spark.read.schema(df.schema).parquet(staged), buckets_for(_bytes(spark, staged))
    column = f"bucket_of_{buckets}"
    # Adaptive execution brings each bucket together in files of its target size and splits large ones.
    rows = df.withColumn(column, bucket_of(df, pk, buckets, null_keys)).hint("rebalance", column)
    folder = tables.replace(rows, path, [column])
    _keep_schema(spark, folder, column, df.schema)
    if staged:
        _delete(spark, staged)


def _keep_schema(spark: SparkSession, folder: str, column: str, schema: T.StructType) -> None:
    """A table without rows still has a file, for its columns."""
    if not layout(spark, folder):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{column}=0")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as it is; without one, no rows of the schema."""
    if tables.exists(spark, path):
        return tables.read(spark, path)
    if schema is None:
        raise ValueError("the table has not been written yet")
    return spark.createDataFrame([], schema)


def finish_change(spark: SparkSession, path: str) -> None:
    """Write staged rows of touched buckets over those of the table, if a change has left any."""
    change, folder = f"{path.rstrip('/')}/{_CHANGE}", tables.rows_folder(spark, path)
    if not tables.finished(spark, change):
        _delete(spark, change)
        return
    (column, touched), = layout(spark, change).items()
    at, system = filesystem(spark, change)
    filled = [b for b in touched if system.getContentSummary(filesystem(spark, f"{change}/{column}={b}")[0]).getFileCount()]
    schema = _schema(spark, folder, column, layout(spark, folder)[column][0])
    if filled:
        files = [f"{change}/{column}={b}" for b in filled]
        rows = spark.read.schema(_with(schema, column)).option("basePath", change).parquet(*files)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(column).parquet(folder)
    for bucket in set(touched) - set(filled):  # these have no rows any more
        _delete(spark, f"{folder}/{column}={bucket}")
    _keep_schema(spark, folder, column, schema)
    system.delete(at, True)


def _schema(spark: SparkSession, folder: str, column: str, bucket: int) -> T.StructType:
    """The columns of the table, from one bucket: the others need not be listed."""
    return spark.read.parquet(f"{folder}/{column}={bucket}").schema


def _with(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, T.IntegerType())])


def change_buckets(
    path: str,
    stage: DataFrame,
    pk: Sequence[str],
    change: Callable[[DataFrame, DataFrame], DataFrame],
    schema: T.StructType,
    buckets: int | None = None,
    rebalance: bool = True,
    null_keys: bool = False,
) -> bool:
    """Rewrite the buckets that hold a key of the stage.

    ``change`` gets the rows of those buckets and the stage, and returns the new rows of the buckets. A change that is
    repeated has to give the same rows; then a batch of a stream that is replayed leaves the table as it is. Without
    ``rebalance`` the new rows are written by the tasks that make them. With ``null_keys`` null is a key like any other. A table
    that does not lie in buckets yet is written anew first. Returns whether there was a change.
    """
    spark, path = stage.sparkSession, path.rstrip("/")
    if stage.isEmpty():
        return False
    folder = tables.rows_folder(spark, path)
    if folder is None:
        publish(change(spark.createDataFrame([], schema), stage), path, pk, buckets, null_keys)
        return True
    finish_change(spark, path)
    if not layout(spark, folder):
        publish(tables.read(spark, path), path, pk, buckets, null_keys)
        folder = tables.rows_folder(spark, path)
    (column, present), = layout(spark, folder).items()
    n = int(tables.BUCKET_COLUMN.fullmatch(column)[1])

    schema = _schema(spark, folder, column, present[0])
    wanted = [f for f in schema.fields if f.name not in AUDIT and (f.name in stage.columns or not null_keys)]
    arriving = conform(stage, T.StructType(wanted))
    # At most one row per bucket.
    touched = {r[0] for r in arriving.select(bucket_of(arriving, pk, n, null_keys)).distinct().collect()}
    files = [f"{folder}/{column}={b}" for b in sorted(touched & set(present))]
    state = spark.createDataFrame([], schema)
    if files:
        state = spark.read.schema(_with(schema, column)).option("basePath", folder).parquet(*files).drop(column)
    new = conform(change(state, stage), schema)
    rows = new.withColumn(column, bucket_of(new, pk, n, null_keys))
    if rebalance:
        rows = rows.hint("rebalance", column)
    staged = f"{path}/{_CHANGE}"
    for bucket in touched:  # a bucket that is empty in the end is still listed
        at, system = filesystem(spark, f"{staged}/{column}={bucket}")
        system.mkdirs(at)
    rows.write.mode("append").partitionBy(column).parquet(staged)
    strange = set(layout(spark, staged)[column]) - touched
    if strange:
        _delete(spark, staged)
        raise ValueError(f"the change made rows for buckets {sorted(strange)[:5]}, which hold none of its keys")
    finish_change(spark, path)
    if _bytes(spark, folder) > 2 * BUCKET_BYTES * n:
        publish(tables.read(spark, path), path, pk, None, null_keys)
    return True


def publish_upsert(
    path: str,
    stage: DataFrame,
    pk: Sequence[str],
    run_ts: str | datetime,
    schema: T.StructType,
    buckets: int | None = None,
) -> bool:
    """Insert and update the rows of the stage in the table, bucket by bucket.

    A small stage is broadcast to the table, whose files hold one bucket each:
    they are then rewritten one by one and nothing of the table is shuffled.
    """
    spark = stage.sparkSession
    path_of_stage = fresh_path(spark, "upsert")

    def merge(state: DataFrame, new: DataFrame) -> DataFrame:
        return upsert(state, new, pk, run_ts)

    try:
        stage.write.parquet(path_of_stage)
        rows = spark.read.schema(stage.schema).parquet(path_of_stage)
        return change_buckets(path, rows, pk, merge, schema, buckets, rebalance=not fits_broadcast(rows))
    finally:  # the change is written by now, or has failed
        _delete(spark, path_of_stage)
