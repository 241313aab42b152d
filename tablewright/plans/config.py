"""Mappings from the JSON configuration of a table load."""

from __future__ import annotations

import re
from collections.abc import Mapping as Config
from typing import Any

from tablewright.plans.mapping import (
    DRIVING,
    Condition,
    Delta,
    Disposition,
    Field,
    History,
    Join,
    Mapping,
    OrderKey,
    TargetType,
)


def _table_name(table: str | Config[str, Any] | None) -> str | None:
    if not table or isinstance(table, str):
        return table or None
    return ".".join(p for p in (table.get("dataset_name"), table.get("table_name")) if p)


def _flag(field: Config[str, Any], *names: str) -> bool:
    """Key flags go by two names; what counts is their value."""
    return any(bool(field.get(n)) for n in names)


class _Aliases:
    """Fully qualified table names in SQL text, replaced by the alias in the join."""

    def __init__(self, parameters: Config[str, Any]) -> None:
        self.names = {parameters["driving_table"]: DRIVING}
        for join in parameters.get("joins") or ():
            name = _table_name(join["right"])
            alias = join["right"].get("alias") if isinstance(join["right"], dict) else None
            self.names.setdefault(name, alias or name.split(".")[-1])

    def text(self, sql: str | None) -> str | None:
        for name in sorted(self.names, key=len, reverse=True):
            if sql:
                sql = re.sub(rf"(?<![\w.]){re.escape(name)}(?=\.)", self.names[name], sql)
        return sql

    def alias_of(self, field: Config[str, Any]) -> str:
        table = field.get("source_table") or field.get("source_name")
        if isinstance(table, dict) and table.get("alias"):
            return table["alias"]
        return self.names.get(_table_name(table), _table_name(table) or DRIVING)


def _conditions(items, aliases: _Aliases) -> tuple[Condition, ...]:
    return tuple(
        Condition(
            [aliases.text(f) for f in item.get("fields", ())[:2]],
            item.get("operator", "="),
            item.get("condition") or "and",
        )
        for item in items or ()
    )


def _source_text(field: Config[str, Any], aliases: _Aliases) -> str:
    if field.get("transformation"):
        return aliases.text(field["transformation"])
    return f"{aliases.alias_of(field)}.{field['source_column']}"


def _history(item, fields: tuple[Field, ...], aliases: _Aliases) -> History | None:
    if not item:
        return None
    mapped = {
        f"{f.source_table}.{f.source_column}": f.target_name
        for f in fields
        if f.source_column and not f.transformation and not f.default
    }

    def target(field: Config[str, Any]) -> str:
        if field.get("name"):
            return field["name"]
        source = _source_text(field, aliases)
        if source not in mapped:
            raise ValueError(f"history column {source!r} is not a column of the target")
        return mapped[source]

    keys = []
    for entry in item.get("order") or ():
        source = _source_text(entry.get("field") or entry, aliases)
        keys.append(OrderKey(mapped.get(source, source), bool(entry.get("is_desc"))))
    plain = [target(f) for f in item["partition"]]
    driving = [target(f) for f in item["driving_column"]]
    return History(plain, driving, tuple(keys)) if keys else History(plain, driving)


def mapping_from_config(parameters: Config[str, Any]) -> Mapping:
    """A :class:`Mapping` from the ``parameters`` of a table-building task.

    Expressions are Spark SQL. Sources go by their ``dataset.table`` names.
    """
    kind = parameters.get("target_type", "TYPE1")
    if kind not in TargetType.__members__:
        raise ValueError(f"target type {kind!r} is not supported; use TYPE1 or HISTORY")
    aliases = _Aliases(parameters)
    fields = tuple(
        Field(
            name=f.get("name"),
            data_type=f.get("data_type"),
            source_column=f.get("source_column"),
            source_table=aliases.alias_of(f),
            transformation=aliases.text(f.get("transformation")),
            default=aliases.text(f.get("default")),
            nullable=f.get("is_nullable", True) is not False,
            pk=_flag(f, "pk", "is_primary_key"),
            hk=_flag(f, "hk", "is_history_key"),
        )
        for f in parameters.get("source_to_target") or ()
    )
    joins = tuple(
        Join(
            _table_name(j["right"]),
            _conditions(j.get("on"), aliases),
            j.get("type", "left"),
            (j["right"].get("alias") if isinstance(j["right"], dict) else None)
            or aliases.names[_table_name(j["right"])],
        )
        for j in parameters.get("joins") or ()
    )
    delta = parameters.get("delta")
    return Mapping(
        target=parameters["destination_table"],
        driving_table=parameters["driving_table"],
        fields=fields,
        target_type=TargetType[kind],
        joins=joins,
        where=_conditions(parameters.get("where"), aliases),
        delta=delta
        and Delta(
            _source_text(delta["field"], aliases),
            aliases.text(delta["lower_bound"]),
            delta.get("upper_bound"),
        ),
        history=_history(parameters.get("history"), fields, aliases),
        disposition=Disposition.of(parameters.get("write_disposition")),
        block_data_check=bool(parameters.get("block_data_check")),
    )
