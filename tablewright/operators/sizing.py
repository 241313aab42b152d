"""Measured sizes, and joins that broadcast only what has been measured."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest side that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

_ROW_OVERHEAD = 32


def row_bytes(df: DataFrame) -> Column:
    """An upper estimate of the bytes one row takes in memory."""
    size = F.lit(_ROW_OVERHEAD + 8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column).cast("long"), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            text = F.to_json(F.struct(column))
            size = size + F.coalesce(F.octet_length(text).cast("long") * 4, F.lit(0))
    return size


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df``, counted and measured, take at most ``limit`` bytes."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` when it has been measured to be small.

    Beyond the limit the join is left to shuffle and to adaptive execution.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def null_safe_on(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of the key columns of two aliased frames, null equal to null."""
    terms = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(operator.and_, terms)
