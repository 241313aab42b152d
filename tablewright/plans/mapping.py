"""The declarative model of a table load: what to read, join, filter and map."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.spelling import expression

#: Alias of the driving table of a load.
DRIVING = "src"

# Audit and history columns of a target table.
CREATED = "dw_created_dt"
MODIFIED = "dw_last_modified_dt"
AUDIT = (CREATED, MODIFIED)
EFFECTIVE_FROM = "effective_from_dt"
EFFECTIVE_CSN = "effective_from_dt_csn_seq"
EFFECTIVE_SEQ = "effective_from_dt_seq"
EFFECTIVE_TO = "effective_to_dt"


class TargetType(Enum):
    TYPE1 = "TYPE1"
    HISTORY = "HISTORY"


class Disposition(Enum):
    APPEND = "WRITEAPPEND"
    TRANSIENT = "WRITETRANSIENT"
    TRUNCATE = "WRITETRUNCATE"
    DELETE = "DELETE"

    @classmethod
    def of(cls, text: str | Disposition | None) -> Disposition:
        """Both spellings, with and without the underscore, are accepted."""
        if isinstance(text, cls):
            return text
        return cls((text or "WRITETRUNCATE").upper().replace("_", ""))


@dataclass(frozen=True)
class Field:
    """One column of the target and where its value comes from."""

    name: str | None = None
    data_type: str | None = None
    source_column: str | None = None
    source_table: str = DRIVING
    transformation: str | None = None
    default: str | None = None
    nullable: bool = True
    pk: bool = False
    hk: bool = False

    @property
    def target_name(self) -> str:
        return self.name or infer_name(self)

    def value(self) -> Column:
        """The mapped expression, without its name."""
        if self.transformation:
            mapped = expression(self.transformation)
        else:
            mapped = F.col(f"{self.source_table}.{self.source_column or self.name}")
        return F.coalesce(mapped, expression(self.default)) if self.default else mapped

    def column(self) -> Column:
        return self.value().alias(self.target_name)


def infer_name(item: Field) -> str:
    """Name of a field that has none of its own.

    A source column keeps its name. An expression is called after what it begins
    with: ``<column>_<type>`` for a cast, ``case``, or the name of the function.
    """
    if item.source_column:
        return item.source_column
    text = (item.transformation or "").strip()
    call = re.match(r"(\w*)\(", text)
    inner = text[call.end():] if call else text
    cast = re.match(r"(\w+)\s+as\s+(\w+)", inner, re.IGNORECASE)
    if cast:
        return f"{cast.group(1)}_{cast.group(2)}"
    if re.match(r"case\b", inner, re.IGNORECASE):
        return "case"
    if call and call.group(1):
        return call.group(1)
    raise ValueError(f"cannot name the field with transformation {text!r}")


@dataclass(frozen=True)
class Condition:
    """A comparison of two SQL operands, and how it is tied to the one before."""

    fields: Sequence[str | None]
    operator: str = "="
    connective: str = "and"


@dataclass(frozen=True)
class Join:
    """A join of a mapping.

    Without an equality between both sides, the same one in all alternatives of an ``or``,
    every pair of rows is compared. That is done when the right side has been measured to be
    small; ``unbounded`` allows it for any size.
    """

    right: str
    on: Sequence[Condition] = ()
    how: str = "left"
    alias: str | None = None
    unbounded: bool = False


@dataclass(frozen=True)
class OrderKey:
    expression: str
    desc: bool = False


@dataclass(frozen=True)
class Delta:
    """Incremental extraction: ``lower <= field < upper``."""

    field: str
    lower_bound: str
    upper_bound: int | None = None


@dataclass(frozen=True)
class History:
    """What a history tracks: per ``partition``, changes of ``driving`` columns.

    Partition and driving columns are target names. Order keys are target names
    or expressions over the sources; left out, rows follow the effective-from
    columns.
    """

    partition: Sequence[str]
    driving: Sequence[str]
    order: Sequence[OrderKey] = (
        OrderKey(EFFECTIVE_FROM),
        OrderKey(EFFECTIVE_CSN),
        OrderKey(EFFECTIVE_SEQ),
    )


@dataclass(frozen=True)
class Mapping:
    """A whole load of one target table."""

    target: str
    driving_table: str
    fields: Sequence[Field]
    target_type: TargetType = TargetType.TYPE1
    joins: Sequence[Join] = ()
    where: Sequence[Condition] = ()
    delta: Delta | None = None
    history: History | None = None
    disposition: Disposition = Disposition.TRUNCATE
    block_data_check: bool = False
    mapped: tuple[Field, ...] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        # The loads own the audit columns; a mapping that lists them is not obeyed.
        kept = tuple(f for f in self.fields if f.target_name not in AUDIT)
        object.__setattr__(self, "mapped", kept)

    @property
    def primary_keys(self) -> list[str]:
        return [f.target_name for f in self.mapped if f.pk]

    @property
    def history_keys(self) -> list[str]:
        return [f.target_name for f in self.mapped if f.hk]

    def with_(self, **changes) -> Mapping:
        return replace(self, **changes)
