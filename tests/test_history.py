import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators.checks import check_mapping, check_open_history
from tablewright.operators.history import (
    build_history,
    cdc_filter,
    close_intervals,
    history_stage,
    open_rows,
)
from tablewright.plans.loads import run_load, scd2_delta, scd2_full
from tablewright.plans.mapping import Delta, Field, History, Mapping, OrderKey, TargetType
from tests.helpers import plan, rows, same_rows, skewed, ts

RUN, FIRST = "2024-02-01 00:00:00", "2024-01-15 00:00:00"
HIGH = ts("2999-12-31 23:59:59")

MAPPING = Mapping(
    "hist",
    "s",
    (
        Field("k", pk=True, hk=True),
        Field("effective_from_dt", source_column="at", pk=True),
        Field("effective_from_dt_csn_seq", source_column="seq", pk=True),
        Field("effective_from_dt_seq", transformation="1", pk=True),
        Field("v"),
    ),
    TargetType.HISTORY,
    history=History(["k"], ["v"]),
)


def history_of(spark, values, driving=("v",)):
    """Kept values of one key with the given sequence of driving values."""
    names = ", ".join(driving)
    listed = ", ".join(f"({i}, {', '.join(v if isinstance(v, tuple) else (v,))})" for i, v in enumerate(values))
    df = spark.sql(f"select 'a' as k, * from values {listed} as t(i, {names})")
    history = History(["k"], list(driving), (OrderKey("i"),))
    kept = cdc_filter(history_stage(df, history), list(driving))
    return [tuple(r) if len(driving) > 1 else r[0] for r in kept.orderBy("i").select(*driving).collect()]


@pytest.mark.parametrize(
    "values, kept",
    [
        (["'A'", "'A'", "'B'", "'B'", "'A'"], ["A", "B", "A"]),
        (["null", "null", "'A'"], ["A"]),
        (["'A'", "null", "'A'"], ["A", None, "A"]),
        (["'NULL'", "null"], ["NULL", None]),
        (["cast(null as string)"], []),
    ],
)
def test_change_detection(spark, values, kept):
    assert history_of(spark, values) == kept


def test_any_driving_column_counts(spark):
    values = [("1", "1"), ("1", "2"), ("1", "2"), ("2", "2"), ("cast(null as int)", "2")]
    assert history_of(spark, values, ("v", "w")) == [(1, 1), (1, 2), (2, 2), (None, 2)]


def test_intervals_close_at_the_next_row(spark):
    df = spark.sql(
        """select k, cast(f as timestamp_ntz) as effective_from_dt, c as effective_from_dt_csn_seq,
                  s as effective_from_dt_seq
           from values ('a', '2024-01-01', 1, 1), ('b', '2024-01-01', 1, 1), ('b', '2024-01-01', 1, 2),
                       ('b', '2024-01-01', 2, 1), ('b', '2024-01-03', 0, 1) as t(k, f, c, s)"""
    )
    closed = close_intervals(df, ["k"])
    assert closed.columns[-1] == "effective_to_dt"
    found = rows(closed, "k", "effective_from_dt_csn_seq", "effective_from_dt_seq", "effective_to_dt")
    day = ts("2024-01-01")
    assert found == [
        ("a", 1, 1, HIGH),
        ("b", 0, 1, HIGH),
        ("b", 1, 1, day),
        ("b", 1, 2, day),
        ("b", 2, 1, ts("2024-01-03")),
    ]


@pytest.fixture(scope="module")
def source(spark):
    return skewed(spark, 1500).cache()


@pytest.mark.parametrize("rows_per_task", [None, 60])
def test_invariants(source, rows_per_task):
    built = scd2_full(MAPPING, {"s": source}, RUN, rows_per_task=rows_per_task).cache()
    order = Window.partitionBy("k").orderBy("effective_from_dt", "effective_from_dt_csn_seq")
    pairs = built.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("v", "effective_from_dt")])
    inner = pairs.where("next_effective_from_dt is not null")
    assert inner.where("effective_to_dt != next_effective_from_dt").count() == 0
    assert inner.where("v <=> next_v").count() == 0
    per_key = open_rows(built).groupBy("k").count()
    assert per_key.where("count != 1").count() == 0
    assert per_key.count() == source.select("k").distinct().count()
    assert check_open_history(built, ["k"]).first()["result"]
    assert all(r["result"] for r in check_mapping(built, MAPPING).collect())


def test_hot_keys_give_the_same_history(source):
    expected = scd2_full(MAPPING, {"s": source}, RUN)
    for rows_per_task in (60, 300):
        same_rows(scd2_full(MAPPING, {"s": source}, RUN, rows_per_task=rows_per_task), expected)


def test_order_over_the_sources(source):
    """With an order of its own for the changes, hot keys are cut twice."""
    other = MAPPING.with_(history=History(["k"], ["v"], (OrderKey("src.seq % 7", True), OrderKey("src.seq"))))
    expected = scd2_full(other, {"s": source}, RUN)
    assert [c for c in expected.columns if c.startswith("_")] == []
    same_rows(scd2_full(other, {"s": source}, RUN, rows_per_task=80), expected)


CUT = ts("2024-01-01 05:00")


@pytest.mark.parametrize("rows_per_task", [None, 80])
def test_delta_on_top_of_full_is_full(source, rows_per_task):
    """Loading in two steps gives the history of loading at once."""
    known = source.where("k is not null")
    delta = MAPPING.with_(delta=Delta("src.at", f"timestamp_ntz'{CUT}'"))
    target = scd2_full(MAPPING, {"s": known.where(F.col("at") < F.lit(str(CUT)))}, FIRST, created=True)
    built = scd2_delta(delta, {"s": known}, target, CUT, RUN, rows_per_task=rows_per_task).cache()
    at_once = scd2_full(MAPPING, {"s": known}, RUN)
    same_rows(built.drop("dw_created_dt", "dw_last_modified_dt"), at_once.drop("dw_last_modified_dt"))
    assert rows(built.groupBy("dw_created_dt").count()) == [
        (ts(FIRST), target.count()),
        (ts(RUN), built.count() - target.count()),
    ]


def test_delta_row_that_repeats_the_value_before_is_no_change(spark):
    source = spark.sql(
        """select k, cast(at as timestamp_ntz) as at, cast(seq as bigint) as seq, v
           from values ('a', '2024-01-01', 1, 'X'), ('a', '2024-01-05', 2, 'X'), ('a', '2024-01-06', 3, 'X'),
                       ('b', '2024-01-01', 4, 'X'), ('b', '2024-01-06', 5, 'Y'), ('c', '2024-01-02', 6, 'Z'),
                       ('d', '2024-01-06', 7, 'N') as t(k, at, seq, v)"""
    )
    delta = MAPPING.with_(delta=Delta("src.at", "$TODAY", 2 * 86400))
    target = scd2_full(MAPPING, {"s": source.where("at < timestamp_ntz'2024-01-05'")}, FIRST, created=True)
    built = run_load(delta, {"s": source}, RUN, target=target, as_of=ts("2024-01-05"))
    found = rows(built, "k", "effective_from_dt_csn_seq", "effective_to_dt", "dw_created_dt", "dw_last_modified_dt")
    assert found == [
        ("a", 1, HIGH, ts(FIRST), ts(RUN)),
        ("b", 4, ts("2024-01-06"), ts(FIRST), ts(RUN)),
        ("b", 5, HIGH, ts(RUN), ts(RUN)),
        ("c", 6, HIGH, ts(FIRST), ts(FIRST)),
        ("d", 7, HIGH, ts(RUN), ts(RUN)),
    ]


def test_null_is_a_history_key_in_steps_as_at_once(spark):
    source = spark.sql(
        """select cast(null as string) as k, cast(at as timestamp_ntz) as at, cast(seq as bigint) as seq, v
           from values ('2024-01-01', 1, 'X'), ('2024-01-05', 2, 'Y') as t(at, seq, v)"""
    )
    delta = MAPPING.with_(delta=Delta("src.at", "$TODAY"))
    target = scd2_full(MAPPING, {"s": source.where("seq = 1")}, FIRST, created=True)
    built = scd2_delta(delta, {"s": source}, target, ts("2024-01-05"), RUN)
    assert rows(built, "effective_from_dt_csn_seq", "effective_to_dt") == [(1, ts("2024-01-05")), (2, HIGH)]
    at_once = scd2_full(MAPPING, {"s": source}, RUN)
    same_rows(built.drop("dw_created_dt", "dw_last_modified_dt"), at_once.drop("dw_last_modified_dt"))


def test_late_arrival_takes_its_place_and_leaves_one_open_row(spark):
    source = spark.sql(
        """select k, cast(at as timestamp_ntz) as at, cast(seq as bigint) as seq, v, cast(come as timestamp_ntz) as come
           from values ('a', '2024-01-01', 1, 'A', '2024-01-01'), ('a', '2024-01-05', 2, 'B', '2024-01-05'),
                       ('a', '2024-01-03', 3, 'B', '2024-02-01') as t(k, at, seq, v, come)"""
    )
    delta = MAPPING.with_(delta=Delta("src.come", "timestamp_ntz'2024-02-01'"))
    target = scd2_full(MAPPING, {"s": source.where("seq < 3")}, FIRST, created=True)
    built = scd2_delta(delta, {"s": source}, target, ts("2024-02-01"), RUN)
    same_rows(
        built.drop("dw_created_dt", "dw_last_modified_dt"),
        scd2_full(MAPPING, {"s": source}, RUN).drop("dw_last_modified_dt"),
    )
    assert check_open_history(built, ["k"]).first()["result"]


def test_empty_delta_changes_nothing(spark, source):
    known = source.where("k is not null")
    target = scd2_full(MAPPING, {"s": known}, FIRST, created=True)
    delta = MAPPING.with_(delta=Delta("src.at", "$TODAY"))
    same_rows(scd2_delta(delta, {"s": known}, target, ts("2030-01-01"), RUN), target)


def test_history_needs_a_description(spark):
    with pytest.raises(ValueError, match="history"):
        scd2_full(MAPPING.with_(history=None), {"s": spark.range(1)}, RUN)


def test_one_shuffle_and_one_sort(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = events.selectExpr(
        "user_id as k",
        "ts as effective_from_dt",
        "event_id as effective_from_dt_csn_seq",
        "1 as effective_from_dt_seq",
        "event_type as v",
        "value",
    )
    found = plan(build_history(df, History(["k"], ["v"])).drop("value"))
    assert found.count("Exchange ") == 1 and found.count("Sort [") == 1
    assert "value" not in found[found.index("ReadSchema") :]
