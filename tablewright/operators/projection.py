"""Projections: source-to-target mappings, audit columns, target order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.dates import ntz
from tablewright.plans.mapping import AUDIT, CREATED, MODIFIED, Field


def project(df: DataFrame, fields: Sequence[Field], extra: Sequence[Column] = ()) -> DataFrame:
    """Map sources to target columns; audit columns in the mapping are left out."""
    mapped = [f.column() for f in fields if f.target_name not in AUDIT]
    return df.select(*mapped, *extra)


def _leading_keys(fields: Sequence[Field]) -> int:
    count = 0
    while count < len(fields) and fields[count].pk:
        count += 1
    return max(count, 1)


def audit_order(fields: Sequence[Field], names: Sequence[str]) -> list[str]:
    """Target column order: the audit columns follow the leading primary key."""
    plain = [n for n in names if n not in AUDIT]
    present = [n for n in AUDIT if n in names]
    at = _leading_keys([f for f in fields if f.target_name not in AUDIT])
    return plain[:at] + present + plain[at:]


def with_audit(df: DataFrame, run_ts: str | datetime | Column, created: bool = False) -> DataFrame:
    """Stamp the load time; ``created`` adds the creation time of incremental targets."""
    df = df.withColumn(MODIFIED, ntz(run_ts))
    return df.withColumn(CREATED, ntz(run_ts)) if created else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; other columns are left out.

    A nullable column ``df`` lacks is null; a required one is an error.
    """
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            columns.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
        elif field.nullable:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"required column {field.name!r} is missing")
    return df.select(*columns)
