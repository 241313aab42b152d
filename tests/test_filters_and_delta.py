import pytest
from pyspark.sql import functions as F

from tablewright.operators.filters import apply_where
from tablewright.plans.delta import before, delta_bounds, delta_filter
from tablewright.plans.mapping import Condition
from tests.helpers import rows, ts


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.sql("select * from values (1, 1, 0), (1, 0, 1), (0, 1, 0), (0, 0, 1), (null, 1, 0) as t(a, b, c)")


def keep(df, *conditions):
    return rows(apply_where(df, [Condition(*c) for c in conditions]))


def test_and_binds_before_or(numbers):
    one = "1"
    chain = [(["a", one],), (["b", one], "=", "and"), (["c", one], "=", "or")]
    expected = rows(numbers.where("a = 1 and b = 1 or c = 1"))
    assert keep(numbers, *chain) == expected and len(expected) == 3


def test_first_connective_does_not_count(numbers):
    assert keep(numbers, (["a", "1"], "=", "or"), (["b", "1"], "=", None)) == [(1, 1, 0)]


def test_not_connective(numbers):
    assert keep(numbers, (["a", "1"],), (["b", "1"], "=", "not")) == [(1, 0, 1)]
    assert keep(numbers, (["a", "1"], "=", "not")) == rows(numbers.where("not (a = 1)"))


def test_in_lists_and_null(numbers):
    assert len(keep(numbers, (["a", "1, 2"], "in"))) == 2
    assert len(keep(numbers, (["a", "(1, 2)"], "not in"))) == 2
    assert keep(numbers, (["a", "1, null"], "NOT IN")) == []
    assert len(keep(numbers, (["a", None], "is null"))) == 1
    assert len(keep(numbers, (["a", ""], "is not null"))) == 4


@pytest.mark.parametrize("how, expected", [("=", 1), ("!=", 2), ("<>", 2), ("<", 1), ("<=", 2), (">", 1), (">=", 2)])
def test_comparisons(spark, how, expected):
    df = spark.sql("select * from values (1), (2), (3), (null) as t(x)")
    assert len(keep(df, (["x", "2"], how))) == expected


def test_unknown_comparison(numbers):
    with pytest.raises(ValueError, match="like"):
        keep(numbers, (["a", "1"], "like"))
    with pytest.raises(ValueError, match="xor"):
        keep(numbers, (["a", "1"],), (["a", "1"], "=", "xor"))


def bounds(spark, *args):
    lo, hi = delta_bounds(*args)
    row = spark.range(1).select(lo.alias("lo"), (F.lit(None) if hi is None else hi).alias("hi")).first()
    return row["lo"], row["hi"]


@pytest.mark.parametrize(
    "as_of, token, lower",
    [
        ("2024-01-28 10:00", "$TODAY", "2024-01-28"),
        ("2024-01-28 10:00", "$today", "2024-01-28"),
        ("2024-03-01", "$YESTERDAY", "2024-02-29"),
        ("2024-01-28", "$THISWEEK", "2024-01-22"),
        ("2024-01-29", "$THISWEEK", "2024-01-29"),
        ("2024-01-28", "$LASTWEEK", "2024-01-15"),
        ("2024-02-29 23:59", "$THISMONTH", "2024-02-01"),
        ("2024-02-01", "$THISMONTH", "2024-02-01"),
    ],
)
def test_tokens(spark, as_of, token, lower):
    assert bounds(spark, token, None, ts(as_of)) == (ts(lower), None)


def test_upper_bounds(spark):
    day = ts("2024-01-30")
    assert bounds(spark, "$TODAY", 90, day)[1] == ts("2024-01-30 00:01:30")
    assert bounds(spark, "$TODAY", 0, day)[1] == ts("2999-12-31 23:59:59")
    with pytest.raises(ValueError):
        delta_bounds("$TODAY", -1, day)


def test_run_parameters(spark):
    given = {"lower_date_bound": "10-MAY-2022", "upper_date_bound": "11-MAY-2022 10:00:00"}
    found = bounds(spark, "@lower_date_bound", 5, ts("2024-01-30"), given)
    assert found == (ts("2022-05-10"), ts("2022-05-11 10:00:00.999999"))
    with pytest.raises(ValueError, match="lower_date_bound"):
        delta_bounds("@LOWER_DATE_BOUND", None, ts("2024-01-30"))


def test_window_and_its_complement(spark):
    df = spark.sql(
        """select timestamp_ntz'2024-01-29 23:59:59' as t union all select timestamp_ntz'2024-01-30 00:00:00'
           union all select timestamp_ntz'2024-01-31 00:00:00' union all select null"""
    )
    lo, hi = delta_bounds("$TODAY", 86400, ts("2024-01-30"))
    assert rows(delta_filter(df, "t", lo, hi)) == [(ts("2024-01-30"),)]
    assert rows(before(df, "t", lo)) == [(ts("2024-01-29 23:59:59"),)]
    assert delta_filter(df, "ifnull(t, timestamp_ntz'2024-02-01')", lo, None).count() == 3
