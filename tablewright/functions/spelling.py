"""Expressions of mappings in the spellings that job configurations use, as Spark SQL expressions.

Spark knows most of them (``ifnull``, ``if``, ``date``, ``timestamp``, ``extract(dayofweek from x)``). What it spells
differently is put into its words: dates plus or minus an interval, the last day of a part, and times parsed by
``%``-directives. Names of functions within quotes are left alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Directives of time formats, and Spark's patterns for them.
_DIRECTIVES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%e": "d",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "DDD",
    "%H": "HH",
    "%I": "hh",
    "%p": "a",
    "%M": "mm",
    "%S": "ss",
    "%E6S": "ss.SSSSSS",
    "%E3S": "ss.SSS",
    "%F": "yyyy-MM-dd",
    "%T": "HH:mm:ss",
    "%%": "'%'",
}
#: Months of the parts whose last day can be asked for.
_MONTHS = {"month": 1, "quarter": 3, "year": 12}

#: Units that Spark's intervals do without.
_UNITS = {"week": (7, "day"), "quarter": (3, "month")}

_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")
_CALL = re.compile(r"(?i)\b(date_add|date_sub|timestamp_add|timestamp_sub|last_day|parse_timestamp)\s*\(")
_INTERVAL = re.compile(r"(?is)interval\s+(.+?)\s+(\w+)\s*")


def _arguments(text: str, begin: int) -> tuple[list[str], int]:
    """The arguments of a call whose parenthesis ends before ``begin``, and the place after the call."""
    depth, at, start, found = 1, begin, begin, []
    while at < len(text):
        quoted = _QUOTED.match(text, at)
        if quoted:
            at = quoted.end()
            continue
        character = text[at]
        depth += (character in "([") - (character in ")]")
        if not depth or (character == "," and depth == 1):
            found.append(text[start:at].strip())
            start = at + 1
        at += 1
        if not depth:
            return found, at
    raise ValueError(f"the parentheses of {text!r} do not match")


def java_pattern(directives: str) -> str:
    """A time format with ``%``-directives as Spark's pattern."""
    parts = re.split(r"(%E[36]S|%.)", directives)
    unknown = [p for p in parts[1::2] if p not in _DIRECTIVES]
    if unknown:
        raise ValueError(f"the time format {directives!r} has unknown directives {unknown}")
    plain = [re.sub(r"[A-Za-z]+", r"'\g<0>'", p.replace("'", "''")) for p in parts[0::2]]
    given = [_DIRECTIVES[p] for p in parts[1::2]]
    return "".join(a + b for a, b in zip(plain, [*given, ""], strict=True))


def _said(name: str, arguments: list[str]) -> str:
    if name == "parse_timestamp":
        if len(arguments) != 2 or arguments[0][:1] not in "'\"":
            raise ValueError(f"parse_timestamp takes a format and a text, not {arguments}")
        pattern = java_pattern(arguments[0][1:-1]).replace("'", "\\'")
        return f"to_timestamp_ntz({arguments[1]}, '{pattern}')"
    if name == "last_day":
        part = arguments[1].lower() if len(arguments) > 1 else "month"
        if part not in _MONTHS:
            raise ValueError(f"no last day of {part!r}")
        return f"date_sub(add_months(trunc({arguments[0]}, '{part}'), {_MONTHS[part]}), 1)"
    interval = _INTERVAL.fullmatch(arguments[1]) if len(arguments) == 2 else None
    if not interval:
        return f"{name}({', '.join(arguments)})"
    number, unit = interval.groups()
    scale, unit = _UNITS.get(unit.lower(), (1, unit.lower()))
    # A constant keeps a date a date; Spark makes a time of a date plus a product.
    constant = re.fullmatch(r"-?\d+", number)
    moved = f"interval '{int(number) * scale}' {unit}" if constant else f"({number}) * interval '{scale}' {unit}"
    return f"(({arguments[0]}) {'-' if name.endswith('_sub') else '+'} {moved})"


def spark_sql(text: str) -> str:
    """``text`` with the calls above in Spark's words."""
    out, at = [], 0
    while at < len(text):
        quoted = _QUOTED.match(text, at)
        call = None if quoted else _CALL.match(text, at)
        if quoted:
            out.append(quoted[0])
            at = quoted.end()
        elif call and not re.match(r"[\w.]", text[at - 1 : at] or " "):
            arguments, at = _arguments(text, call.end())
            out.append(_said(call[1].lower(), [spark_sql(a) for a in arguments]))
        else:
            out.append(text[at])
            at += 1
    return "".join(out)


def expression(text: str) -> Column:
    """A column from the text of a mapping."""
    return F.expr(spark_sql(text))
