"""Small helpers for frames of documents."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that go to a Python worker at once; texts may be long.
ROWS_PER_BATCH = 500


def small_batches(spark: SparkSession) -> SparkSession:
    """Let Python workers see few rows at a time, as each may hold a long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def per_text(function: Callable[[pd.Series], pd.Series | pd.DataFrame], schema: str) -> Callable[[Column], Column]:
    """A vectorised function of whole texts that the optimizer evaluates once per row.

    Marked as not deterministic, so that a filter on its result does not evaluate it again.
    """
    return F.pandas_udf(function, schema).asNondeterministic()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def deal(rows: DataFrame, label: str, by: str, bound: int) -> tuple[DataFrame, dict]:
    """At most ``bound`` different rows of each ``label``, those with the smallest hash of ``by``; the counts of all.

    A first cut on the hash leaves about twice the bound, so little is sorted. It goes by the number of different
    values of ``by``, so a corpus of few values in many copies is not cut down to nothing.
    """
    stats = rows.groupBy(label).agg(F.count("*").alias("n"), F.approx_count_distinct(by).alias("values")).collect()
    order = F.xxhash64(by, F.lit(17))
    near = F.lit(False)
    for r in stats:
        limit = int((min(1.0, 2 * bound / max(1, r["values"])) * 2 - 1) * (1 << 62))
        near = near | (F.col(label).eqNullSafe(F.lit(r[label])) & (F.shiftright(order, 1) <= limit))
    nth = F.row_number().over(Window.partitionBy(label).orderBy(order, *rows.columns))
    picked = rows.where(near).distinct().withColumn("_nth", nth).where(F.col("_nth") <= bound).drop("_nth")
    return picked, {r[label]: r["n"] for r in stats}
