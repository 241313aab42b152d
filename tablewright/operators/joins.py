"""Join chains of a mapping."""

from __future__ import annotations

import re
from collections.abc import Mapping as Sources
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.filters import conditions_column
from tablewright.operators.sizing import fits_broadcast
from tablewright.plans.mapping import DRIVING, Condition, Join

_QUALIFIED = re.compile(r"(\w+)\.(\w+)")
_CONSTANT = re.compile(r"'[^']*'|-?\d+(\.\d+)?|null|true|false", re.IGNORECASE)


def _sides(operand: str | None, right_alias: str) -> set[str]:
    """Which sides an operand reads: ``left``, ``right``, both, or none for a constant."""
    named = re.sub(r"'[^']*'", "", operand or "")
    return {"right" if alias == right_alias else "left" for alias, _ in _QUALIFIED.findall(named)}


def _left_operands(on: Sequence[Condition], right_alias: str) -> list[str] | None:
    """Columns and expressions of the left side the conditions use, if no operand mixes sides."""
    used = []
    for operand in (o for condition in on for o in condition.fields if o):
        sides = _sides(operand, right_alias)
        if len(sides) > 1 or not (sides or _CONSTANT.fullmatch(operand.strip())):
            return None
        if sides == {"left"}:
            used.append(operand.strip())
    return list(dict.fromkeys(used))


def _has_equality(on: Sequence[Condition], right_alias: str) -> bool:
    """Whether an equality holds between both sides in every pair that the chain joins.

    That is one in all alternatives of the chain, with the same operands: Spark takes it
    out of them and joins by it, and compares the rest within equal values.
    """

    def across(condition: Condition) -> frozenset[str] | None:
        sides = [_sides(o, right_alias) for o in condition.fields]
        if condition.operator.strip() == "=" and sorted(map(tuple, sides)) == [("left",), ("right",)]:
            return frozenset(o.strip() for o in condition.fields)
        return None

    alternatives: list[set[frozenset[str] | None]] = [set()]
    for position, condition in enumerate(on):
        tie = (condition.connective or "and").lower()
        if tie == "or" and position:
            alternatives.append(set())
        if tie != "not":
            alternatives[-1].add(across(condition))
    return bool(set.intersection(*alternatives) - {None})


def _guarded(right: DataFrame, join: Join, alias: str) -> DataFrame:
    """The right side of a join that compares all pairs: broadcast if it is small, else an error."""
    if fits_broadcast(right):
        return F.broadcast(right).alias(alias)
    if join.unbounded:
        return right
    raise ValueError(
        f"the {join.how} join of {alias} has no equality between both sides, and {join.right} is too large "
        f"to compare with every row; add one, or set unbounded"
    )


def _full_join(left: DataFrame, right: DataFrame, join: Join, alias: str) -> DataFrame:
    """Full join as a left join and the right rows without a partner.

    Both parts can be split by adaptive execution when a key is hot, which a
    full outer join cannot; the left side of the second part is reduced to its
    distinct keys before it is shuffled.
    """
    on = conditions_column(join.on)
    matched = left.join(right, on, "left")
    used = _left_operands(join.on, alias)
    keys = left.select(*[F.expr(c).alias(f"_key_{i}") for i, c in enumerate(used)]).distinct() if used else left
    if used:
        names = [f"_key_{i}" for i in range(len(used))]
        keys = keys.alias("_keys")
        renamed = {column: f"_keys.{name}" for column, name in zip(used, names)}
        on = conditions_column(
            [
                Condition([renamed.get((o or "").strip(), o) for o in c.fields], c.operator, c.connective)
                for c in join.on
            ]
        )
    alone = right.join(keys, on, "left_anti")
    padding = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    return matched.union(alone.select(*padding, f"{alias}.*"))


def apply_joins(
    driving: DataFrame, joins: Sequence[Join], sources: Sources[str, DataFrame]
) -> DataFrame:
    """Fold the joins over the driving table.

    Every right side goes under its alias, so one table can be joined twice.
    Which side is broadcast, and how skewed keys are split, is decided by Spark
    from the sizes it sees; a right side that every row is compared with is
    measured first (:class:`Join`).
    """
    joined = driving.alias(DRIVING)
    for join in joins:
        alias = join.alias or join.right
        right = sources[join.right].alias(alias)
        how = join.how.lower()
        if how in ("cross", "left", "inner", "full") and (how == "cross" or join.on) and not _has_equality(join.on, alias):
            right = _guarded(right, join, alias)
        if how == "cross":
            joined = joined.crossJoin(right)
        elif not join.on:
            raise ValueError(f"the {how} join of {join.right} needs a condition")
        elif how == "full":
            joined = _full_join(joined, right, join, alias)
        elif how in ("left", "inner"):
            joined = joined.join(right, conditions_column(join.on), how)
        else:
            raise ValueError(f"unknown join type {join.how!r}")
    return joined


def anti_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a null key never does."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def tracked_rows(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_of``, each once however often it does.

    To look up few keys in a table written for that, see :func:`tablewright.sinks.lookup.narrowed`.
    """
    return df.join(keys_of.select(*keys).distinct(), list(keys), "left_semi")
