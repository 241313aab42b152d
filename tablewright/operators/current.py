"""Archives of repeated records, and their current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.windows import sort_columns
from tablewright.plans.mapping import OrderKey

# Lineage columns of an archive table.
LINEAGE = ("file_name", "file_dt", "load_dt")

#: Which row of a key is current: latest file first, then latest load.
LATEST = (OrderKey("file_dt", desc=True), OrderKey("load_dt", desc=True))


def latest_rows(df: DataFrame, key: Sequence[str], order: Sequence[OrderKey] = LATEST) -> DataFrame:
    """The first row of every key. Keys and order keys are SQL text.

    The limit to the first row is applied within each map task too, so a hot
    key reaches the shuffle as one row per task.
    """
    window = Window.partitionBy(*[F.expr(k) for k in key]).orderBy(*sort_columns(order))
    ranked = df.withColumn("_nth", F.row_number().over(window))
    return ranked.where(F.col("_nth") == 1).drop("_nth")


def current_view(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[OrderKey] = LATEST,
    exclude: Sequence[str] = (),
    tie_break: Sequence[OrderKey] = (),
) -> DataFrame:
    """Current rows of an archive, without lineage and ``exclude`` columns.

    A late file with an earlier date never displaces a newer one. ``tie_break``
    should make the order total.
    """
    return latest_rows(df, key, [*order, *tie_break]).drop(*LINEAGE, *exclude)


def unnest(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    """Pair each row with the elements of its array; rows without elements vanish.

    The elements of an array of structs become columns of their own, next to the
    struct column ``alias`` under which keys can name them.
    """
    exploded = df.select("*", F.explode(array_col).alias(alias))
    kind = exploded.schema[alias].dataType
    if kind.typeName() != "struct":
        return exploded
    return exploded.select("*", *[F.col(f"{alias}.{n}").alias(n) for n in kind.names if n not in df.columns])


def as_array(column: str | Column) -> Column:
    """A single record as the repeated one that an archive stores."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.isNull(), F.array()).otherwise(F.array(column))


def reshape_records(
    df: DataFrame, records: Sequence[str], inside: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Single records to repeated ones, at top level and inside repeated records.

    ``records`` are struct columns; ``inside`` names, per array-of-struct column,
    the fields of its elements that are single records.
    """
    columns = {c: as_array(c) for c in records}
    for outer, names in (inside or {}).items():
        columns[outer] = F.transform(outer, _element_change(names))
    return df.withColumns(columns)


def _element_change(names: Sequence[str]):
    def change(element: Column) -> Column:
        for name in names:
            element = element.withField(name, as_array(element[name]))
        return element

    return change
