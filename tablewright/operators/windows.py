"""Window functions that stay parallel when one key holds much of the data.

A window partition is one task, so a key with a third of all rows would put a
third of the work there. Rows of such hot keys are therefore range-partitioned
and sorted on (key, order), cut into *segments* and staged. Window functions then run
per (key, segment), and what crosses a segment border comes from a small table with
one row per (key, segment). All other keys take the ordinary window.
"""

from __future__ import annotations

from collections.abc import Mapping as Columns
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.sizing import broadcast_if_small, null_safe_on
from tablewright.plans.mapping import OrderKey
from tablewright.session import stage

#: Rows of one key that a window may be given, and rows that a task should sort.
ROWS_PER_TASK = 4_000_000

#: Most tasks that sort the rows of hot keys, as Spark samples every one of them on the
#: driver. Tasks keep to ``ROWS_PER_TASK`` for 4 * 10^11 rows; segments keep to it always.
MAX_TASKS = 200_000

KEY, SEGMENT, TIE, HOT = "_key", "_segment", "_tie", "_hot"


def sort_columns(order: Sequence[OrderKey | str], reverse: bool = False) -> list[Column]:
    """Sort expressions: nulls first ascending, last descending, as Spark does."""
    columns = []
    for key in order:
        key = OrderKey(key) if isinstance(key, str) else key
        column = F.expr(key.expression)
        columns.append(column.desc() if key.desc != reverse else column.asc())
    return columns


def hot_keys(
    df: DataFrame, partition: Sequence[str], rows_per_task: int
) -> tuple[DataFrame | None, int]:
    """The keys with more rows than one task should take, and their rows in total.

    Rows are counted by key before anything is shuffled. The counts are kept on
    the executors' disks, for the case that there are hot keys to list; lost
    ones are counted again.
    """
    counts = df.groupBy(*partition).agg(F.count("*").alias("_rows")).persist(StorageLevel.DISK_ONLY)
    try:
        if (counts.agg(F.max("_rows")).first()[0] or 0) <= rows_per_task:
            return None, 0
        hot = counts.where(F.col("_rows") > rows_per_task).withColumn(KEY, F.monotonically_increasing_id())
        hot = stage(hot, "hot-keys")
    finally:
        counts.unpersist()
    return hot.select(*partition, KEY), hot.agg(F.sum("_rows")).first()[0]


def spread_hot_keys(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[OrderKey | str],
    rows_per_task: int | None = None,
) -> list[tuple[DataFrame, list[str]]]:
    """Split ``df`` into parts, each with the columns to partition a window by.

    Without hot keys this is ``df`` and ``partition``. Otherwise the second part
    holds the hot keys, numbered, and cut into segments that follow ``order``:
    every segment holds a contiguous run of a key. Rows that tie are told apart by
    a number of their own, so a run of ties is cut as well. The part is staged, so
    that the cut is the same for all that is computed from it; so is ``df``.

    A task sorts a range of rows and cuts it into segments by place. The tasks, of
    which the driver hears, so follow from the rows, not from ``rows_per_task``.
    """
    limit = rows_per_task or ROWS_PER_TASK
    keys, hot_rows = hot_keys(df, partition, limit)
    if keys is None:
        return [(df, list(partition))]
    # One pass over the input writes hot and cold rows apart.
    joined = df.alias("rows").join(broadcast_if_small(keys).alias("hot"), null_safe_on("rows", "hot", partition), "left")
    marked = joined.select("rows.*", KEY, F.col(KEY).isNotNull().cast("int").alias(HOT))
    rows = stage(marked, "windowed", [HOT])
    cold = rows.where(F.col(HOT) == 0).drop(KEY, HOT)
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(max(2, 2 * hot_rows // limit), max(shuffled, 2 * hot_rows // ROWS_PER_TASK), MAX_TASKS)
    hot = rows.where(F.col(HOT) == 1).drop(HOT).withColumn(TIE, F.monotonically_increasing_id())
    total = [F.col(KEY), *sort_columns(order), F.col(TIE)]
    hot = hot.repartitionByRange(tasks, *total).sortWithinPartitions(*total)
    # Places begin at a multiple of 2^33 in every task, so tasks have no segment in common.
    hot = stage(hot.withColumn(SEGMENT, F.expr(f"monotonically_increasing_id() div {int(limit)}")), "segments")
    return [(cold, list(partition)), (hot, [KEY, SEGMENT])]


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [p.drop(KEY, SEGMENT, TIE) for p in parts])


def _is_segmented(partition: Sequence[str]) -> bool:
    return list(partition) == [KEY, SEGMENT]


def _total(order: Sequence[OrderKey | str], partition: Sequence[str]) -> list[OrderKey | str]:
    """``order``, in which rows of a segment do not tie."""
    return [*order, OrderKey(TIE)] if _is_segmented(partition) else list(order)


def _keyed(partition: Sequence[str]):
    return Window.partitionBy(*[F.col(f"`{k}`") for k in partition])


def _attach(df: DataFrame, borders: DataFrame) -> DataFrame:
    """Join a table with one row per (key, segment) to the rows of the segments.

    The rows are partitioned and sorted that way for their window already, so
    only the small table moves.
    """
    borders = borders.withColumnsRenamed({KEY: "_on_key", SEGMENT: "_on_segment"})
    on = (F.col(KEY) == F.col("_on_key")) & (F.col(SEGMENT) == F.col("_on_segment"))
    return df.join(borders, on, "left").drop("_on_key", "_on_segment")


def _beyond(
    df: DataFrame,
    order: Sequence[OrderKey | str],
    values: Columns[str, Column],
    offset: int,
) -> DataFrame:
    """Per (key, segment), the ``|offset|`` rows just outside of the segment, in order.

    A segment's own edge is found by a row limit, which Spark applies before the
    shuffle. Each segment has a row at least, so ``|offset|`` neighbouring
    segments hold enough of them.
    """
    reach = abs(offset)
    inward = _keyed([KEY, SEGMENT]).orderBy(*sort_columns(order, reverse=offset < 0))
    edge = (
        df.select(
            KEY,
            SEGMENT,
            F.row_number().over(inward).alias("_nth"),
            F.struct(*[v.alias(name) for name, v in values.items()]).alias("_value"),
        )
        .where(F.col("_nth") <= reach)
        .groupBy(KEY, SEGMENT)
        .agg(F.sort_array(F.collect_list(F.struct("_nth", "_value")), asc=offset > 0).alias("_edge"))
    )
    frame = (-reach, -1) if offset < 0 else (1, reach)
    across = _keyed([KEY]).orderBy(SEGMENT).rowsBetween(*frame)
    return edge.select(KEY, SEGMENT, F.flatten(F.collect_list("_edge").over(across)).alias("_beyond"))


def neighbours(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[OrderKey | str],
    values: Columns[str, Column],
    offset: int,
    default: Column | None = None,
) -> DataFrame:
    """Add columns holding ``values`` of the row ``offset`` places away in the key.

    A negative offset looks back (lag), a positive one ahead (lead). ``default``
    stands in where there is no such row, not where its value is null. ``df``
    and ``partition`` are a part from :func:`spread_hot_keys`.
    """
    if offset == 0:
        raise ValueError("offset must not be 0")
    order = _total(order, partition)
    reach = abs(offset)
    shift = F.lag if offset < 0 else F.lead
    window = _keyed(partition).orderBy(*sort_columns(order))
    missing = F.lit(None) if default is None else default
    shifted = {name: shift(value, reach).over(window) for name, value in values.items()}

    if not _is_segmented(partition):
        if default is not None:
            exists = shift(F.lit(1), reach).over(window).isNotNull()
            shifted = {name: F.when(exists, c).otherwise(missing) for name, c in shifted.items()}
        return df.select("*", *[c.alias(name) for name, c in shifted.items()])

    around = window.rowsBetween(-reach, -1) if offset < 0 else window.rowsBetween(1, reach)
    inside = df.select(
        "*",
        *[c.alias(name) for name, c in shifted.items()],
        F.count(F.lit(1)).over(around).cast("int").alias("_inside"),
    )
    joined = _attach(inside, _beyond(df, order, values, offset))
    short = F.lit(reach) - F.col("_inside")
    at = F.size("_beyond") - short if offset < 0 else short - 1
    outside = F.when((at >= 0) & (at < F.size("_beyond")), F.get("_beyond", at))
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            F.when(short == 0, F.col(f"`{name}`"))
            .when(outside.isNotNull(), outside["_value"][name])
            .otherwise(missing)
            .alias(name)
            for name in values
        ],
    )


def _ranked(
    df: DataFrame, kind: str, partition: Sequence[str], order: Sequence[OrderKey | str], name: str
) -> DataFrame:
    """``row_number`` or ``rank``, as a long.

    A run of ties may cross segments. Its rank then is where the run begins, which
    each segment takes from the segments before it.
    """
    by = _keyed(partition)
    if not _is_segmented(partition):
        function = F.row_number() if kind == "row_number" else F.rank()
        return df.withColumn(name, function.over(by.orderBy(*sort_columns(order))).cast("long"))
    across = _keyed([KEY]).orderBy(SEGMENT)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "row_number":
        place = F.row_number().over(by.orderBy(*sort_columns(_total(order, partition))))
        sizes = df.groupBy(KEY, SEGMENT).agg(F.count("*").alias("_n"))
        before = sizes.select(KEY, SEGMENT, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        ranked = _attach(df.withColumn(name, place), before)
        return ranked.withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_before")

    values = [F.expr(OrderKey(k).expression if isinstance(k, str) else k.expression) for k in order]
    value = F.struct(*[v.alias(f"_{i}") for i, v in enumerate(values)])
    ranked = df.select("*", F.rank().over(by.orderBy(*sort_columns(order))).alias(name), value.alias("_value"))
    ends = ranked.groupBy(KEY, SEGMENT).agg(
        F.count("*").alias("_n"),
        F.min_by("_value", name).alias("_first"),
        F.max_by("_value", name).alias("_last"),
        F.max(name).alias("_run"),
    )
    goes_on = F.lag("_n").over(across).isNotNull() & F.col("_first").eqNullSafe(F.lag("_last").over(across))
    ends = ends.select(
        "*", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), goes_on.alias("_goes_on")
    )
    # Where the segment's last run begins, unless it began in a segment before.
    whole = F.col("_goes_on") & F.col("_first").eqNullSafe(F.col("_last"))
    ends = ends.withColumn("_begins", F.when(~whole, F.col("_before") + F.col("_run")))
    ends = ends.select(
        KEY, SEGMENT, "_before", "_goes_on", "_first", F.last("_begins", ignorenulls=True).over(earlier).alias("_carried")
    )
    carried = F.col("_goes_on") & F.col("_value").eqNullSafe(F.col("_first"))
    place = F.when(carried, F.col("_carried")).otherwise(F.col(name) + F.col("_before"))
    joined = _attach(ranked, ends).withColumn(name, place.cast("long"))
    return joined.drop("_value", "_before", "_goes_on", "_first", "_carried")


def _place(columns: Sequence[str], name: str, position: int | None) -> list[str]:
    """A new column goes to its position or the end; a same-named one is replaced."""
    if name in columns:
        return list(columns)
    at = len(columns) if position is None else position
    return [*columns[:at], name, *columns[at:]]


def analytic(
    df: DataFrame,
    kind: str,
    column: str | None,
    partition: Sequence[str],
    order: Sequence[OrderKey | str],
    offset: int = 1,
    default: str | None = None,
    name: str | None = None,
    position: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add one analytic column: ``lag``, ``lead``, ``row_number`` or ``rank``.

    ``column`` and ``default`` are SQL text. The result replaces a column of the
    same name, else goes to ``position``, else to the end. Partition and order
    keys may be expressions.
    """
    kind = kind.lower()
    if kind not in ("lag", "lead", "row_number", "rank"):
        raise ValueError(f"unknown analytic {kind!r}")
    name = name or (f"prev_{column}" if kind == "lag" else f"next_{column}" if kind == "lead" else kind)
    result = "_analytic"

    order = [OrderKey(k) if isinstance(k, str) else k for k in order]
    partition = list(partition) or ["1"]
    extra = {f"_part_{i}": F.expr(p) for i, p in enumerate(partition)}
    extra |= {f"_sort_{i}": F.expr(k.expression) for i, k in enumerate(order)}
    keyed = df.select("*", *[c.alias(n) for n, c in extra.items()])
    keys = [f"_part_{i}" for i in range(len(partition))]
    sorting = [OrderKey(f"_sort_{i}", k.desc) for i, k in enumerate(order)]

    parts = []
    for part, by in spread_hot_keys(keyed, keys, sorting, rows_per_task):
        if kind in ("lag", "lead"):
            parts.append(
                neighbours(
                    part,
                    by,
                    sorting,
                    {result: F.expr(column)},
                    -offset if kind == "lag" else offset,
                    F.expr(default) if default else None,
                )
            )
        else:
            parts.append(_ranked(part, kind, by, sorting, result))
    done = union_parts(parts)
    return done.select(
        *[
            F.col(result).alias(name) if c == name else F.col(f"`{c}`")
            for c in _place(df.columns, name, position)
        ]
    )
