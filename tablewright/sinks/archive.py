"""Archives of landed rows, partitioned by the day of their file.

An archive keeps all rows that ever landed, and is read by windows of file dates. It lies in folders by day
(``file_dt_day``), which windows name (:func:`tablewright.plans.delta.delta_filter` and loads with a delta): Spark then lists and reads
only those. A current view is brought up to date from the days since it was last, instead of the whole archive.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.current import LATEST, latest_rows
from tablewright.plans.delta import day_of, delta_filter
from tablewright.plans.mapping import OrderKey
from tablewright.functions.dates import ntz
from tablewright.sinks.keyed import change_buckets

FILE_DATE = "file_dt"


def with_day(df: DataFrame, by: str = FILE_DATE) -> DataFrame:
    return df.withColumn(day_of(by), F.to_date(F.col(f"`{by}`")))


def add_to_archive(df: DataFrame, path: str, by: str = FILE_DATE) -> None:
    """Append rows to the days of their files. Adaptive execution brings a day together and splits large ones."""
    rows = with_day(df, by).hint("rebalance", day_of(by))
    rows.write.mode("append").partitionBy(day_of(by)).parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All rows, with the column of days, by which windows are found."""
    return spark.read.parquet(path)


def refresh_current(
    archive: DataFrame,
    path: str,
    key: Sequence[str],
    since: str | datetime,
    order: Sequence[OrderKey] = LATEST,
    by: str = FILE_DATE,
) -> bool:
    """Work the files dated ``since`` or later into the current view at ``path``; whether there were any.

    The view keeps its lineage, so files older than what it has do not win. Only days of the window are read, and only buckets
    of their keys are written. A view that is not there yet begins with these files.
    """
    rows = delta_filter(archive, by, ntz(since), None).drop(day_of(by))

    def merge(state: DataFrame, new: DataFrame) -> DataFrame:
        return latest_rows(state.unionByName(latest_rows(new, key, order)), key, order)

    return change_buckets(path, rows, key, merge, rows.schema, null_keys=True)
