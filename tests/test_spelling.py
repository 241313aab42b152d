"""Expressions in the spellings of job configurations."""

import pytest

from tablewright.functions.spelling import expression, java_pattern, spark_sql
from tablewright.plans.loads import run_load
from tablewright.plans.mapping import Condition, Delta, Field, Mapping
from tests.helpers import rows, ts


def test_what_spark_knows_is_left_alone():
    for text in (
        "ifnull(cast(src.a as string), 'NULL')",
        "extract(dayofweek from src.at)",
        "'date_add(x, interval 1 day)'",
        "src.last_day + t.date_add",
        "date_add(d, 3)",
        "my_last_day(x, month)",
        "concat('it''s', \"(\", `a)b`)",
    ):
        assert spark_sql(text) == text


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("date_add(date '2024-01-31', interval 1 day)", "2024-02-01"),
        ("date_sub(date '2024-03-31', interval 1 month)", "2024-02-29"),
        ("DATE_ADD(date_sub(date '2024-01-01', interval 1 week), INTERVAL 2 year)", "2025-12-25"),
        ("date_add(date '2024-01-01', interval 2 quarter)", "2024-07-01"),
        ("date_sub(timestamp_ntz '2024-01-01 00:00:00', interval 90 second)", "2023-12-31 23:58:30"),
        ("timestamp_add(timestamp_ntz '2024-01-01 10:00:00', interval (1 + 1) hour)", "2024-01-01 12:00:00"),
        ("date_add(date '2024-01-01', interval if(1 > 0, 5, 6) day)", "2024-01-06 00:00:00"),
        ("last_day(date '2024-02-03', month)", "2024-02-29"),
        ("last_day(date '2024-02-03')", "2024-02-29"),
        ("last_day(date '2024-05-03', quarter)", "2024-06-30"),
        ("last_day(date_sub(date '2024-01-15', interval 1 month), year)", "2023-12-31"),
        ("parse_timestamp('%d-%b-%Y %H:%M:%S', '05-Jan-2024 10:11:12')", "2024-01-05 10:11:12"),
        ("parse_timestamp('%Y-%m-%dT%H:%M:%E6S', concat('2024-01-05', 'T10:11:12.000345'))", "2024-01-05 10:11:12.000345"),
        ("parse_timestamp('%F %T', '2024-01-05 10:11:12')", "2024-01-05 10:11:12"),
        ("extract(dayofweek from date '2024-01-07')", "1"),
        ("timestamp(date_add(last_day(date_sub(date '2024-03-31', interval 1 month)), interval 1 day))", "2024-03-01 00:00:00"),
    ],
)
def test_values(spark, text, expected):
    assert spark.range(1).select(expression(text).cast("string")).first()[0] == expected


def test_what_cannot_be_said():
    with pytest.raises(ValueError, match="do not match"):
        spark_sql("date_add(x, interval 1 day")
    with pytest.raises(ValueError, match="unknown directives"):
        java_pattern("%Y-%q")
    with pytest.raises(ValueError, match="no last day"):
        spark_sql("last_day(x, decade)")
    with pytest.raises(ValueError, match="a format and a text"):
        spark_sql("parse_timestamp(fmt, x)")
    assert java_pattern("%H h") == "HH 'h'" and java_pattern("%Y-%m-%dT%T") == "yyyy-MM-dd'T'HH:mm:ss"


def test_mappings_take_them_everywhere(spark):
    source = spark.sql(
        """select * from values (1, '01-Jan-2024 00:00:00'), (2, '15-Jan-2024 08:00:00'), (3, null) as t(id, written)"""
    )
    at = "parse_timestamp('%d-%b-%Y %H:%M:%S', src.written)"
    mapping = Mapping(
        "t",
        "s",
        (
            Field("id", pk=True),
            Field("until", transformation=f"date_add({at}, interval 1 day)", default="timestamp_ntz '2999-12-31 00:00:00'"),
        ),
        where=(Condition([f"last_day({at}, month)", "date '2024-01-31'"]), Condition(["src.id", "3"], "=", "or")),
    )
    found = run_load(mapping, {"s": source}, "2024-02-01 00:00:00").select("id", "until")
    assert rows(found) == [(1, ts("2024-01-02")), (2, ts("2024-01-16 08:00")), (3, ts("2999-12-31"))]
    window = mapping.with_(where=(), delta=Delta(at, "date_sub(date '2024-01-20', interval 1 week)"))
    state = run_load(window, {"s": source}, "2024-02-01 00:00:00", as_of=ts("2024-01-20"))
    assert rows(state, "id") == [(2,)]
