"""Registry of the runnable queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.mapping import EFFECTIVE_TO
from tablewright.sources.sql import read_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Parameters of the runs in the catalog.
RUN_TS = "2024-02-01 00:00:00"
FIRST_LOAD = "2024-01-20 00:00:00"
AS_OF = datetime(2024, 1, 30)


def _end_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(EFFECTIVE_TO, F.date_format(EFFECTIVE_TO, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _end_as_text_sql(oracle: str) -> str:
    text = f"strftime({EFFECTIVE_TO}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"SELECT * REPLACE ({text} AS {EFFECTIVE_TO}) FROM ({oracle})"


def query(*tables: str, oracle: str | None = None, name: str | None = None, open_ended: bool = False):
    """Register a function of ``(spark, *tables)`` under its name.

    The registered query takes ``(spark, folder)`` and reads the tables whole.
    ``open_ended`` results hold the open end date, which is later than pandas
    timestamps reach; the column is shown as text, for those who use ``toPandas``.
    """

    def register(function):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            frames = read_tables(spark, folder, tables)
            result = function(spark, *frames.values())
            return _end_as_text(result) if open_ended else result

        run.__name__ = key
        run.__doc__ = function.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = _end_as_text_sql(oracle) if open_ended else oracle
        return function

    return register
