"""Plans of catalog queries are the ones that scale."""

import re

import pytest

from tablewright.catalog import QUERIES
from tests.helpers import plan

FOLDER = "/root/testdata/sf0.001"


def scans(text):
    """Columns read and filters pushed, per scan."""
    return [
        (set(re.findall(r"(\w+):", schema)), filters)
        for filters, schema in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text)
    ]


def plan_of(spark, name):
    return plan(QUERIES[name](spark, FOLDER))


def test_bounds_reach_the_scan(spark):
    for name in ("delta_window", "delta_yesterday", "delta_params", "delta_literal"):
        [(columns, filters)] = scans(plan_of(spark, name))
        assert "GreaterThanOrEqual(ts" in filters, name
        assert columns == {"event_id", "ts", "user_id"}, name


def test_only_mapped_columns_are_read(spark):
    found = scans(plan_of(spark, "dim_lookup"))
    assert {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"} in [c for c, _ in found]
    assert any("EqualTo(o_orderstatus,F)" in f for _, f in found)
    assert any("EqualTo(c_mktsegment,MACHINERY)" in f for _, f in found)


@pytest.mark.parametrize("name", ["join_theta", "join_chain", "join_full", "dim_lookup", "check_new_value"])
def test_no_nested_loops(spark, name):
    found = plan_of(spark, name)
    assert "NestedLoop" not in found and "Cartesian" not in found


def test_full_join_is_not_a_full_outer_join(spark):
    found = plan_of(spark, "join_full")
    assert "FullOuter" not in found and "LeftAnti" in found


def test_one_shuffle_per_window(spark):
    for name in ("window_lag", "window_lead", "window_row_number", "window_rank"):
        assert plan_of(spark, name).count("Exchange hashpartitioning") == 1, name


def test_no_python_in_any_query(spark):
    """All row logic is in built-in expressions."""
    for name in ("scd2_full", "type1_delta_upsert", "current_view", "file_date_extract", "nested_reshape"):
        found = plan_of(spark, name)
        assert "Python" not in found and "Arrow" not in found, name


def test_small_upsert_does_not_shuffle_the_target(spark):
    """The target's rows, as against its keys, are read and joined in place."""
    found = plan_of(spark, "type1_delta_upsert")
    assert "SortMergeJoin" not in found
    target_branch = found[found.index("Union") : found.index("LeftAnti")]
    before_scan = target_branch[: target_branch.index("dw_created_dt#") + 1]
    assert "BroadcastHashJoin" in target_branch and "Exchange hashpartitioning" not in before_scan


def test_skewed_join_is_split(spark):
    """A join on a hot key, before a window on the same key, is still split."""
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "6",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        from tablewright.operators.joins import apply_joins
        from tablewright.plans.mapping import Condition, Join

        hot = spark.range(40000).selectExpr("if(id % 2 = 0, 0, id % 50) as k", "id", "uuid() as s").repartition(8)
        dim = spark.range(50).selectExpr("id as k", "concat('n', id) as name")
        joined = apply_joins(hot, [Join("dim", [Condition(["src.k", "dim.k"])])], {"dim": dim})
        assert len(joined.collect()) == 40000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
