import pytest
from pyspark.sql import types as T

from tablewright.operators import checks
from tablewright.operators.current import current_view, latest_rows, reshape_records, unnest
from tablewright.plans.mapping import OrderKey, TargetType
from tests.helpers import plan, rows, skewed


@pytest.fixture(scope="module")
def archive(spark):
    return spark.sql(
        """select file_name, cast(file_dt as timestamp) as file_dt, cast(load_dt as timestamp) as load_dt,
                  from_json(p, 'array<struct<season int, league int>>') as parameters, results
           from values
             ('a', '2024-01-02', '2024-01-02', '[{"season": 1, "league": 7}]', 10),
             ('b', '2024-01-03', '2024-01-03', '[{"season": 1, "league": 7}]', 11),
             ('c', '2024-01-01', '2024-01-09', '[{"season": 1, "league": 7}]', 12),
             ('d', '2024-01-01', '2024-01-01', '[]', 13),
             ('e', '2024-01-01', '2024-01-01', null, 14),
             ('f', '2024-01-01', '2024-01-01', '[{"season": 2, "league": 7}, {"season": 3, "league": null}]', 15),
             ('g', '2024-01-01', '2024-01-05', '[{"season": 3, "league": null}]', 16)
             as t(file_name, file_dt, load_dt, p, results)"""
    )


def test_current_rows_per_element(archive):
    nested = unnest(archive, "parameters", "params")
    assert nested.count() == 6
    current = current_view(
        nested, ["params.league", "params.season"], exclude=["league", "season", "params", "parameters"]
    )
    # A late file with an earlier date (c) does not win; of one date, the later load (g) does.
    assert current.columns == ["results"] and rows(current) == [(11,), (15,), (16,)]


def test_unnest_keeps_columns_of_the_same_name(spark):
    df = spark.sql("select 5 as season, array(named_struct('season', 1, 'league', 2)) as parameters")
    nested = unnest(df, "parameters", "params")
    assert nested.select("season", "league", "params.season").first() == (5, 2, 1)
    assert rows(unnest(spark.sql("select array(1, 2) as a"), "a", "e"), "e") == [(1,), (2,)]


def test_limit_applies_before_the_shuffle(spark):
    data = skewed(spark)
    found = plan(latest_rows(data, ["k"], [OrderKey("at", True), OrderKey("seq", True)]))
    before_shuffle = found[found.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_reshape(spark):
    df = spark.sql(
        """select named_struct('total', 1) as paging, cast(null as struct<id: int>) as venue,
                  array(named_struct('team', named_struct('id', 3), 'x', 4)) as response"""
    )
    shaped = reshape_records(df, ["paging", "venue"], {"response": ["team"]})
    assert shaped.schema["response"].dataType.elementType["team"].dataType.typeName() == "array"
    row = shaped.first()
    assert row["paging"][0]["total"] == 1 and row["venue"] == []
    assert row["response"][0]["team"][0]["id"] == 3 and row["response"][0]["x"] == 4


def verdict(df):
    return tuple(df.first())


def test_row_count(spark):
    assert verdict(checks.check_row_count(spark.range(2))) == ("row_count", True, 0)
    assert verdict(checks.check_row_count(spark.range(0))) == ("row_count", False, 1)


def test_duplicates_count_null_keys(spark):
    df = spark.sql("select * from values (1, 1), (1, 2), (null, 1), (null, 1) as t(a, b)")
    assert verdict(checks.check_duplicates(df, ["a", "b"])) == ("duplicate_records", False, 1)
    assert verdict(checks.check_duplicates(df.limit(1), ["a"])) == ("duplicate_records", True, 0)


@pytest.mark.parametrize(
    "values, failed",
    [
        ("('A', '2024-01-01'), ('A', '2024-01-03')", 0),
        ("('A', '2024-01-01'), ('B', '2024-01-03')", 1),
        ("('A', '2024-01-02'), ('A', '2024-01-03'), ('B', '2024-01-02'), ('B', '2024-01-03')", 0),
        ("('A', '2024-01-01'), (null, '2024-01-01'), (null, '2024-01-03')", 1),
        ("('A', '2024-01-01'), ('B', null)", 1),  # A itself is on the last day
        ("('A', '2024-01-01'), ('A', '2024-01-03'), ('B', '2030-01-01')", 1),  # after now, but new
    ],
)
def test_new_values(spark, values, failed):
    df = spark.sql(f"select v, cast(d as timestamp_ntz) as d from values {values} as t(v, d)")
    found = verdict(checks.check_new_value(df, "v", "d", "2024-02-01 00:00:00"))
    assert found == ("new_value", failed == 0, failed)


def test_new_values_of_an_empty_table(spark):
    df = spark.sql("select 'a' as v, timestamp_ntz'2024-01-01' as d").limit(0)
    assert verdict(checks.check_new_value(df, "v", "d", "2024-02-01 00:00:00")) == ("new_value", True, 0)


def test_required(spark):
    df = spark.sql("select * from values (1, 'a'), (null, null) as t(n, s)")
    schema = T.StructType(
        [T.StructField("n", T.IntegerType(), False), T.StructField("s", T.StringType())]
    )
    assert verdict(checks.check_required(df, schema)) == ("required_fields", False, 1)
    wrong = T.StructType([T.StructField("n", T.LongType()), T.StructField("gone", T.StringType())])
    assert verdict(checks.check_required(df, wrong)) == ("required_fields", False, 2)
    assert verdict(checks.check_required(df.where("n = 1"), schema)) == ("required_fields", True, 0)


def test_suite(spark):
    df = spark.sql(
        """select k, timestamp_ntz'2999-12-31 23:59:59' as effective_to_dt from values (1), (1), (2) as t(k)"""
    )
    plain = checks.check_suite(df, "t")
    assert rows(plain) == [("t", "row_count", True, 0)]
    assert rows(checks.check_suite(df, "t", ["k"])) == [
        ("t", "duplicate_records", False, 1),
        ("t", "row_count", True, 0),
    ]
    history = checks.check_suite(df, "t", ["k"], ["k"], TargetType.HISTORY)
    assert ("t", "open_history_items", False, 1) in rows(history) and history.count() == 3
    assert checks.check_suite(df, "t", ["k"], blocked=True).count() == 0
    empty = checks.check_suite(df.limit(0), "t", ["k"])
    assert ("t", "row_count", False, 1) in rows(empty)


def test_keys_are_counted_before_the_shuffle(spark):
    found = plan(checks.check_suite(skewed(spark), "t", ["k"]))
    inner = found[found.rindex("Exchange hashpartitioning") :]
    assert "partial_count" in inner


def test_boundary_is_a_subquery(spark):
    df = skewed(spark)
    found = plan(checks.new_values(df, "v", "at", "2024-02-01 00:00:00"))
    assert "Subquery" in found and "NestedLoop" not in found and "Cartesian" not in found
    assert found.count("Exchange hashpartitioning") == 1
