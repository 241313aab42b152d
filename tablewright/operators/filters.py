"""Conditions of a mapping as boolean columns."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from tablewright.functions.spelling import expression
from tablewright.plans.mapping import Condition

_COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}


def condition_column(condition: Condition) -> Column:
    """One comparison. Operands are SQL text: a column, a constant, an expression."""
    left, right = (tuple(condition.fields) + (None,))[:2]
    how = " ".join(condition.operator.lower().split())
    if how == "is null":
        return expression(left).isNull()
    if how == "is not null":
        return expression(left).isNotNull()
    if how in ("in", "not in"):
        values = right.strip()
        values = values if values.startswith("(") else f"({values})"
        return expression(f"({left}) {how} {values}")
    try:
        return _COMPARE[how](expression(left), expression(right))
    except KeyError:
        raise ValueError(f"unknown comparison {condition.operator!r}") from None


def conditions_column(conditions: Sequence[Condition]) -> Column:
    """A chain without parentheses: AND binds before OR, NOT stands for AND NOT."""
    groups: list[list[Column]] = [[]]
    for position, condition in enumerate(conditions):
        tie = (condition.connective or "and").lower()
        term = condition_column(condition)
        if tie not in ("and", "or", "not"):
            raise ValueError(f"unknown connective {condition.connective!r}")
        if tie == "or" and position:
            groups.append([])
        groups[-1].append(~term if tie == "not" else term)
    return reduce(operator.or_, [reduce(operator.and_, terms) for terms in groups])


def apply_where(df: DataFrame, conditions: Sequence[Condition]) -> DataFrame:
    return df.where(conditions_column(conditions)) if conditions else df
