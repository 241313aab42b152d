import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import windows
from tablewright.operators.windows import analytic, spread_hot_keys
from tablewright.plans.mapping import OrderKey
from tablewright.session import shared_dir
from tests.helpers import plan, same_rows, skewed


@pytest.fixture(scope="module")
def data(spark):
    return skewed(spark, 1500).cache()


ORDERS = {
    "ascending": ["at", "seq"],
    "descending": [OrderKey("at", True), OrderKey("seq", True)],
    "mixed": [OrderKey("v", True), OrderKey("seq")],
    "expression": ["seq % 5", "seq"],
}


@pytest.mark.parametrize("order", ORDERS.values(), ids=list(ORDERS))
@pytest.mark.parametrize("kind, offset", [("lag", 1), ("lag", 7), ("lead", 3)])
def test_hot_keys_give_the_same_neighbours(data, kind, offset, order):
    expected = analytic(data, kind, "v", ["k"], order, offset, "-1", "x")
    split = analytic(data, kind, "v", ["k"], order, offset, "-1", "x", rows_per_task=80)
    same_rows(split, expected)


@pytest.mark.parametrize("kind", ["row_number", "rank"])
@pytest.mark.parametrize("order", [["at", "seq"], ["v"], [OrderKey("v", True)]], ids=["total", "ties", "desc"])
def test_hot_keys_give_the_same_ranks(data, kind, order):
    if kind == "row_number" and len(order) == 1:
        order = [*order, "seq"]
    expected = analytic(data, kind, None, ["k"], order, name="x")
    same_rows(analytic(data, kind, None, ["k"], order, name="x", rows_per_task=80), expected)


def test_offset_beyond_a_whole_segment(data):
    expected = analytic(data, "lag", "seq", ["k"], ["seq"], 150, name="x")
    same_rows(analytic(data, "lag", "seq", ["k"], ["seq"], 150, name="x", rows_per_task=60), expected)


def test_default_is_for_missing_rows_only(spark):
    df = spark.sql("select * from values (1, 'a'), (2, null), (3, 'c') as t(i, s)")
    found = analytic(df, "lag", "s", [], ["i"], default="'none'", name="p")
    assert [r.p for r in found.orderBy("i").collect()] == ["none", "a", None]


def test_no_segment_is_much_larger_than_a_task(data):
    parts = spread_hot_keys(data, ["k"], [OrderKey("at"), OrderKey("seq")], rows_per_task=120)
    assert len(parts) == 2
    cold, hot = parts[0][0], parts[1][0]
    assert cold.count() + hot.count() == data.count()
    assert cold.groupBy("k").count().agg(F.max("count")).first()[0] <= 120
    assert hot.groupBy("_key", "_segment").count().agg(F.max("count")).first()[0] <= 300


def test_null_is_a_key_like_any_other(data):
    parts = spread_hot_keys(data, ["k"], [OrderKey("seq")], rows_per_task=60)
    assert parts[1][0].where("k is null").count() == data.where("k is null").count() > 60


def test_plain_window_without_hot_keys(data):
    found = plan(analytic(data, "lag", "v", ["k"], ["at", "seq"]))
    assert "_segment" not in found and found.count("Exchange hashpartitioning") == 1


def test_names_and_positions(spark):
    df = spark.sql("select 1 as a, 2 as b, 3 as c")
    assert analytic(df, "lag", "b", ["a"], ["c"]).columns == ["a", "b", "c", "prev_b"]
    assert analytic(df, "lead", "b", ["a"], ["c"], name="n", position=1).columns == ["a", "n", "b", "c"]
    assert analytic(df, "row_number", None, ["a"], ["c"], name="b").first() == (1, 1, 3)
    with pytest.raises(ValueError, match="ntile"):
        analytic(df, "ntile", None, ["a"], ["c"])


def test_types_do_not_depend_on_hot_keys(data):
    for kind in ("row_number", "rank"):
        plain = analytic(data, kind, None, ["k"], ["at", "seq"], name="x")
        split = analytic(data, kind, None, ["k"], ["at", "seq"], name="x", rows_per_task=80)
        assert plain.schema["x"].dataType == split.schema["x"].dataType == T.LongType()


def test_ties_are_cut_and_keep_their_rank(spark):
    """One key, in which long runs of rows tie."""
    df = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") % 3).alias("day"), "id")
    parts = spread_hot_keys(df, ["k"], [OrderKey("day")], rows_per_task=1000)
    assert parts[1][0].groupBy("_key", "_segment").count().agg(F.max("count")).first()[0] <= 2000
    expected = analytic(df, "rank", None, ["k"], ["day"], name="x")
    same_rows(analytic(df, "rank", None, ["k"], ["day"], name="x", rows_per_task=1000), expected)
    numbers = analytic(df, "row_number", None, ["k"], ["day"], name="x", rows_per_task=1000)
    assert numbers.agg(F.countDistinct("x"), F.max("x")).first()[:] == (20_000, 20_000)


def test_tasks_do_not_grow_with_the_number_of_segments(spark):
    """A small limit gives many segments, not a task, a file and a sample on the driver for each."""
    df = spark.range(4_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 7).alias("day"), "id")
    part = spread_hot_keys(df, ["k"], [OrderKey("day")], rows_per_task=50)[1][0]
    assert part.count() == 4_000
    assert len(part.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = part.groupBy("_key", "_segment").agg(F.count("*").alias("n"))
    assert segments.count() >= 80 and segments.agg(F.max("n")).first()[0] <= 50
    for kind, column, order in (("rank", None, ["day"]), ("lag", "id", ["day", "id"])):
        expected = analytic(df, kind, column, ["k"], order, 3, name="x")
        same_rows(analytic(df, kind, column, ["k"], order, 3, name="x", rows_per_task=50), expected)


def test_windows_in_turn_stage_few_files_each(spark):
    """Every window over the result of another stages its segments; none has a file for each of them."""
    folders = f"{shared_dir(spark).removeprefix('file:')}/segments-*"
    before = set(glob.glob(folders))
    found = expected = spark.range(1_500).select((F.col("id") % 2).alias("k"), (-F.col("id")).alias("at"))
    for kind, column in (("lag", "at"), ("lead", "at"), ("row_number", None)):
        found = analytic(found, kind, column, ["k"], ["at"], 2, name=kind, rows_per_task=40)
        expected = analytic(expected, kind, column, ["k"], ["at"], 2, name=kind)
    same_rows(found, expected)
    staged = [len(glob.glob(f"{f}/*.parquet")) for f in set(glob.glob(folders)) - before]
    assert len(staged) == 3 and max(staged) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
