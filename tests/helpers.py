from datetime import datetime

from pyspark.sql import functions as F


def ts(text):
    """``'2024-01-02'`` or ``'2024-01-02 03:04'`` as a datetime."""
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """All rows as sorted tuples; nulls last."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is None, v) for v in r])


def same_rows(first, second):
    columns = sorted(first.columns)
    assert columns == sorted(second.columns)
    names = [F.col(f"`{c}`") for c in columns]
    both = first.select(*names, F.lit(1).alias("_side")).union(second.select(*names, F.lit(-1)))
    unequal = both.groupBy(*columns).agg(F.sum("_side").alias("_side")).where("_side != 0").take(5)
    assert not unequal, unequal


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=4000, hot=0.4, keys=9):
    """Rows of which one key holds the fraction ``hot``, with null keys and repeated values."""
    share = F.pmod(F.xxhash64("id"), F.lit(100)) / 100
    key = F.when(share < hot, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(keys)))
    )
    return spark.range(n).select(
        F.when(F.col("id") % 17 != 0, key).alias("k"),
        F.col("id").alias("seq"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") / 3).cast("int"))).alias(
            "at"
        ),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(4))).alias("v"),
    )
