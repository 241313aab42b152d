"""Run a registered query and its SQL on the same tables, and compare the rows."""

import os
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return float(repr(value))
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, query, sql, folder):
    """Column names and rows of both sides, as ``(ours, theirs, missing, unexpected)``."""
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    theirs, expected = _rows([d[0] for d in result.description], result.fetchall())
    df = query(spark, folder)
    ours, found = _rows(df.columns, [tuple(r) for r in df.collect()])
    return ours, theirs, expected - found, found - expected
