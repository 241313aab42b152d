"""Schemas: from table definitions, and of mapped targets."""

from __future__ import annotations

import json
from collections.abc import Mapping as Config
from collections.abc import Sequence
from typing import Any

from pyspark.sql import types as T

from tablewright.plans.mapping import (
    AUDIT,
    CREATED,
    EFFECTIVE_SEQ,
    EFFECTIVE_TO,
    MODIFIED,
    Disposition,
    Field,
    Mapping,
    TargetType,
)
from tablewright.operators.projection import audit_order

# Type names of table definitions.
_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}

#: Where ``effective_to_dt`` goes when there is no sequence column to follow.
_DEFAULT_TO_INDEX = 5


def spark_type(name: str, timestamp: T.DataType | None = None) -> T.DataType:
    """A definition's type name, or else a Spark DDL type, as a Spark type."""
    known = _TYPES.get(name.upper())
    if isinstance(known, T.TimestampType) and timestamp is not None:
        return timestamp
    return known or T.DataType.fromDDL(name)


def schema_from_definition(definition: str | Sequence[Config[str, Any]]) -> T.StructType:
    """The schema a table definition (a list of fields, or its JSON) declares."""
    fields = json.loads(definition) if isinstance(definition, str) else definition
    return T.StructType([_field(f) for f in fields])


def read_definition(path: str) -> T.StructType:
    """The schema of a definition file; a missing file is an error."""
    with open(path, encoding="utf-8") as file:
        return schema_from_definition(json.load(file))


def _field(field: Config[str, Any]) -> T.StructField:
    if field["type"].upper() == "RECORD":
        kind: T.DataType = schema_from_definition(field["fields"])
    else:
        kind = spark_type(field["type"])
    mode = field.get("mode", "NULLABLE").upper()
    if mode == "REPEATED":
        kind = T.ArrayType(kind)
    return T.StructField(field["name"], kind, mode != "REQUIRED")


def target_schema(mapping: Mapping, timestamp: T.DataType | None = None) -> T.StructType | None:
    """The schema of a mapped target with its audit and history columns.

    Transient tables and truncations define no target: None. Pass
    ``TimestampNTZType()`` for sources that hold timestamps without time zone.
    """
    if mapping.disposition in (Disposition.TRANSIENT, Disposition.DELETE):
        return None
    fields = list(mapping.mapped)
    if mapping.target_type is TargetType.HISTORY:
        names = [f.target_name for f in fields]
        at = names.index(EFFECTIVE_SEQ) + 1 if EFFECTIVE_SEQ in names else _DEFAULT_TO_INDEX
        if EFFECTIVE_TO not in names:
            fields.insert(at, Field(EFFECTIVE_TO, "TIMESTAMP", nullable=False))
    by_name = {f.target_name: f for f in fields}
    audit = AUDIT if mapping.delta is not None else (MODIFIED,)
    by_name |= {n: Field(n, "TIMESTAMP", nullable=False) for n in audit}
    order = audit_order(fields, [*by_name])
    return T.StructType(
        [
            T.StructField(n, spark_type(by_name[n].data_type or "STRING", timestamp), by_name[n].nullable)
            for n in order
        ]
    )


def table_definition(schema: T.StructType) -> list[dict[str, str]]:
    """A schema as a definition: ``name``, ``type`` and ``mode`` of each column."""
    names = {v.simpleString(): k for k, v in _TYPES.items()}
    return [
        {
            "name": f.name,
            "type": names.get(f.dataType.simpleString(), f.dataType.simpleString()),
            "mode": "nullable" if f.nullable else "required",
        }
        for f in schema.fields
    ]


__all__ = [
    "CREATED",
    "read_definition",
    "schema_from_definition",
    "spark_type",
    "table_definition",
    "target_schema",
]
