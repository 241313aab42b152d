"""What reaches the scan: days of an archive, and row groups of a table that is looked up by key."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewright.operators.current import latest_rows
from tablewright.operators.joins import tracked_rows
from tablewright.plans.delta import delta_bounds, delta_filter
from tablewright.plans.loads import delta_rows, scd2_delta
from tablewright.plans.mapping import Delta, Field, History, Mapping, OrderKey, TargetType
from tablewright.sinks import keyed
from tablewright.sinks.archive import add_to_archive, read_archive, refresh_current
from tablewright.sinks.lookup import key_filter, narrowed, write_for_lookup
from tests.helpers import plan, rows, same_rows

ORDER = [OrderKey("file_dt", True), OrderKey("id", True)]


def scan_metric(df, name):
    """Sum of a metric of all file scans, after the frame has been computed."""
    df.collect()
    total, open_nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            open_nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            open_nodes.append(node.plan())
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("Scan "):
            total += node.metrics().apply(name).value()
    return total


@pytest.fixture(scope="module")
def landed(spark):
    day = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int") % 20)
    hour = F.make_dt_interval(F.lit(0), F.col("id").cast("int") % 24)
    return spark.range(2000).select("id", (F.col("id") % 300).alias("k"), (day + hour).alias("file_dt")).cache()


@pytest.fixture(scope="module")
def archive(spark, landed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pruning") / "archive")
    add_to_archive(landed.where("id < 1000"), path)
    add_to_archive(landed.where("id >= 1000"), path)
    return path


@pytest.mark.parametrize(
    ("lower", "seconds", "days"),
    [("timestamp_ntz'2024-01-05 10:00:00'", 86400, 2), ("$TODAY", None, 10), ("date '2024-01-03'", 3 * 86400, 4)],
)
def test_windows_list_their_days_only(spark, landed, archive, lower, seconds, days):
    lo, hi = delta_bounds(lower, seconds, datetime(2024, 1, 11, 9))
    found = delta_filter(read_archive(spark, archive), "file_dt", lo, hi)
    assert rows(found, "id") == rows(delta_filter(landed, "file_dt", lo, hi), "id") != []
    assert scan_metric(found, "numPartitions") <= days
    assert "PartitionFilters: []" not in found._jdf.queryExecution().toString()


def test_loads_with_a_delta_list_their_days_only(spark, landed, archive):
    mapping = Mapping("t", "arc", (Field("id", pk=True), Field("k")), delta=Delta("src.file_dt", "$TODAY", 86400))
    found = delta_rows(mapping, {"arc": read_archive(spark, archive)}, datetime(2024, 1, 11))
    assert rows(found) == rows(delta_rows(mapping, {"arc": landed}, datetime(2024, 1, 11))) != []
    assert scan_metric(found, "numPartitions") <= 2


def test_current_view_is_refreshed_from_late_days(spark, landed, tmp_path):
    path, view = f"{tmp_path}/archive", f"{tmp_path}/view"
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    add_to_archive(landed.where(F.col("file_dt") < cut), path)
    assert refresh_current(read_archive(spark, path), view, ["k"], "2024-01-01 00:00:00", ORDER)
    add_to_archive(landed.where(F.col("file_dt") >= cut), path)
    for _ in range(2):  # the second time changes nothing
        assert refresh_current(read_archive(spark, path), view, ["k"], "2024-01-10 00:00:00", ORDER)
        same_rows(keyed.read_table(spark, view), latest_rows(landed, ["k"], ORDER))
    # Files older than what the view has do not win.
    late = landed.where("id between 12 and 18").withColumn("file_dt", cut)
    add_to_archive(late.withColumn("id", F.col("id") - 100), path)
    refresh_current(read_archive(spark, path), view, ["k"], "2024-01-10 00:00:00", ORDER)
    same_rows(keyed.read_table(spark, view), latest_rows(landed, ["k"], ORDER))
    assert not refresh_current(read_archive(spark, path), view, ["k"], "2025-01-01 00:00:00", ORDER)


@pytest.fixture(scope="module")
def lookup(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    df = spark.range(200_000).select((F.col("id") * 2).alias("k"), F.col("id").cast("string").alias("name"))
    df = df.union(spark.sql("select cast(null as bigint), 'none'"))
    write_for_lookup(df, path, ["k"])
    return path


def test_few_keys_read_few_row_groups(spark, lookup):
    table = spark.read.parquet(lookup)
    keys = spark.sql("select * from values (4L), (200000L), (200000L), (77L) as t(k)")
    found = tracked_rows(narrowed(table, keys, ["k"]), keys, ["k"])
    assert rows(found) == [(4, "2"), (200000, "100000")]
    assert "In(k" in plan(found) or "k IN" in plan(found)
    whole = scan_metric(table, "numOutputRows")
    assert scan_metric(narrowed(table, keys, ["k"]), "numOutputRows") < whole
    # 77 lies between the keys of a row group, but its Bloom filter has no such key.
    odd = keys.where("k = 77")
    assert scan_metric(narrowed(table, odd, ["k"]), "numOutputRows") == 0


def test_keys_as_a_filter(spark, lookup):
    table = spark.read.parquet(lookup)
    none = spark.sql("select cast(null as bigint) as k")
    assert rows(table.where(key_filter(none, ["k"]))) == [(None, "none")]
    assert table.where(key_filter(none.limit(0), ["k"])).count() == 0
    many = spark.range(100).withColumnRenamed("id", "k")
    assert key_filter(many, ["k"], limit=99) is None
    assert narrowed(table, many, ["k"], limit=99).count() == 200_001
    both = spark.sql("select * from values (1L, 'x', 0.5D), (2L, null, 1.5D) as t(k, n, d)")
    given = spark.sql("select * from values (1L, 'x', 9D), (2L, 'y', 9D), (2L, null, 9D), (3L, 'x', 9D) as t(k, n, d)")
    passed = given.where(key_filter(both, ["k", "n", "d"]))
    assert rows(passed, "k", "n") == [(1, "x"), (2, None)]
    assert key_filter(both, ["d"]) is None


def test_history_delta_reads_touched_keys_only(spark, tmp_path):
    """The keys of the window reach the scan of the whole source as literals."""
    path = f"{tmp_path}/log"
    log = spark.range(3000).select(
        (F.col("id") % 1000).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int") % 3)).alias("at"),
        (F.col("id") % 7).alias("v"),
    )
    write_for_lookup(log, path, ["k"])
    fields = (
        Field("k", pk=True, hk=True),
        Field("effective_from_dt", source_column="at", pk=True),
        Field("effective_from_dt_csn_seq", transformation="1", pk=True),
        Field("effective_from_dt_seq", transformation="1", pk=True),
        Field("v"),
    )
    delta = Delta("src.at", "timestamp_ntz'2024-01-03 00:00:00'")
    mapping = Mapping("h", "log", fields, TargetType.HISTORY, history=History(["k"], ["v"]), delta=delta)
    source = spark.read.parquet(path)
    some = source.where("k < 20 or at < timestamp_ntz'2024-01-03'")
    empty = spark.createDataFrame([], "k long, effective_from_dt timestamp_ntz, effective_from_dt_csn_seq int, "
                                  "effective_from_dt_seq int, effective_to_dt timestamp_ntz, v long, "
                                  "dw_created_dt timestamp_ntz, dw_last_modified_dt timestamp_ntz")  # fmt: skip
    few = scd2_delta(mapping, {"log": some}, empty, datetime(2024, 1, 5), "2024-01-05 00:00:00")
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr("tablewright.plans.loads.key_filter", lambda keys, names: None)
        all_read = scd2_delta(mapping, {"log": some}, empty, datetime(2024, 1, 5), "2024-01-05 00:00:00")
    same_rows(few, all_read)
    assert few.count() > 0
