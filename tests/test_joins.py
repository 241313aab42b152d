import pytest
from pyspark.sql import functions as F

from tablewright.operators.joins import anti_join, apply_joins, tracked_rows
from tablewright.plans.mapping import Condition, Join
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def left(spark):
    return spark.sql("select * from values (1, 'a'), (1, 'b'), (2, 'c'), (null, 'd'), (5, 'e') as t(k, l)")


@pytest.fixture(scope="module")
def right(spark):
    return spark.sql("select * from values (1, 'x'), (2, 'y'), (3, 'z'), (null, 'w') as t(k, r)")


@pytest.mark.parametrize("how", ["left", "inner", "full"])
def test_join_types(left, right, how):
    joined = apply_joins(left, [Join("r", [Condition(["src.k", "r.k"])], how)], {"r": right})
    expected = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k"), how)
    assert rows(joined, "src.k", "l", "r.k", "r") == rows(expected, "a.k", "l", "b.k", "r")


def test_full_join_with_constants_on_both_sides(left, right):
    on = [Condition(["src.k", "r.k"]), Condition(["src.l", "'b'"], "!="), Condition(["r.r", "'y'"], "!=")]
    joined = apply_joins(left, [Join("r", on, "full")], {"r": right})
    expected = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k and l != 'b' and r != 'y'"), "full")
    assert rows(joined, "src.k", "l", "r.k", "r") == rows(expected, "a.k", "l", "b.k", "r")


def test_full_join_on_an_expression(left, right):
    on = [Condition(["src.k + 1", "r.k"])]
    joined = apply_joins(left, [Join("r", on, "full")], {"r": right})
    expected = left.alias("a").join(right.alias("b"), F.expr("a.k + 1 = b.k"), "full")
    assert rows(joined, "src.k", "l", "r.k", "r") == rows(expected, "a.k", "l", "b.k", "r")


def test_full_join_in_a_chain(left, right):
    """After a full join the aliases of both sides still resolve."""
    joins = [
        Join("r", [Condition(["src.k", "one.k"])], "full", "one"),
        Join("r", [Condition(["one.r", "two.r"])], "left", "two"),
        Join("r", [Condition(["src.k", "three.k"])], "full", "three"),
    ]
    joined = apply_joins(left, joins, {"r": right})
    expected = (
        left.alias("s")
        .join(right.alias("a"), F.expr("s.k = a.k"), "full")
        .join(right.alias("b"), F.expr("a.r = b.r"), "left")
        .join(right.alias("c"), F.expr("s.k = c.k"), "full")
    )
    found = rows(joined, "src.k", "src.l", "one.r", "two.r", "three.r")
    assert found == rows(expected, "s.k", "s.l", "a.r", "b.r", "c.r")


def test_cross_join_needs_no_condition(left, right):
    assert apply_joins(left, [Join("r", how="cross")], {"r": right}).count() == 20
    with pytest.raises(ValueError, match="condition"):
        apply_joins(left, [Join("r")], {"r": right})


def test_anti_and_tracked(left, right):
    assert rows(anti_join(left, right, ["k"])) == [(5, "e"), (None, "d")]
    doubled = right.unionAll(right)
    assert rows(tracked_rows(left, doubled, ["k"])) == [(1, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("how", ["left", "inner", "full"])
def test_an_equality_in_all_alternatives_joins_a_large_right_side(left, right, how, monkeypatch):
    monkeypatch.setattr("tablewright.operators.joins.fits_broadcast", lambda df: False)
    on = [
        Condition(["src.k", "r.k"]),
        Condition(["src.l", "'a'"]),
        Condition(["r.k", " src.k"], "=", "or"),
        Condition(["r.r", "'y'"]),
        Condition(["src.k", "r.k"], "=", "or"),
        Condition(["src.l", "r.r"], "=", "and"),
    ]
    joined = apply_joins(left, [Join("r", on, how)], {"r": right})
    expected = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k and (l = 'a' or r = 'y' or l = r)"), how)
    assert rows(joined, "src.k", "l", "r.k", "r") == rows(expected, "a.k", "l", "b.k", "r")
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


@pytest.mark.parametrize(
    "second",
    [Condition(["src.l", "r.r"], "=", "or"), Condition(["src.k", "r.k"], ">", "or"), Condition(["src.l", "'a'"], "=", "or")],
)
def test_a_large_right_side_without_an_equality_in_all_alternatives_fails(left, right, second, monkeypatch):
    monkeypatch.setattr("tablewright.operators.joins.fits_broadcast", lambda df: False)
    with pytest.raises(ValueError, match="no equality"):
        apply_joins(left, [Join("r", [Condition(["src.k", "r.k"]), second], "inner")], {"r": right})
