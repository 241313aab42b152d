import pytest
from pyspark.sql import types as T

from tablewright.operators.projection import conform, project
from tablewright.plans.config import mapping_from_config
from tablewright.plans.loads import joined_sources, run_load, type1_full
from tablewright.plans.mapping import (
    Condition,
    Delta,
    Disposition,
    Field,
    History,
    Join,
    Mapping,
    OrderKey,
    TargetType,
    infer_name,
)
from tablewright.sources.schema import table_definition, target_schema
from tests.helpers import rows, ts


@pytest.mark.parametrize(
    "field, name",
    [
        (Field(source_column="id"), "id"),
        (Field(transformation="cast(price as string)"), "price_string"),
        (Field(transformation="case when a > 1 then 2 end"), "case"),
        (Field(transformation="(case when a > 1 then 2 end)"), "case"),
        (Field(transformation="upper(name)"), "upper"),
        (Field(transformation="coalesce(cast(a as int), 0)"), "coalesce"),
    ],
)
def test_name_of_unnamed_field(field, name):
    assert infer_name(field) == name


def test_field_that_cannot_be_named():
    with pytest.raises(ValueError):
        infer_name(Field(transformation="a + b"))


def test_disposition_has_two_spellings():
    assert Disposition.of("WRITE_TRUNCATE") is Disposition.of("WRITETRUNCATE") is Disposition.TRUNCATE
    assert Disposition.of("write_append") is Disposition.APPEND
    assert Disposition.of(None) is Disposition.TRUNCATE
    with pytest.raises(ValueError):
        Disposition.of("WRITE_SOMETIMES")


def test_default_covers_column_and_transformation(spark):
    df = spark.sql("select * from values (1, 'a'), (null, null) as t(n, s)").alias("src")
    fields = (Field("n", default="0"), Field("u", transformation="upper(src.s)", default="'?'"))
    assert rows(project(df, fields)) == [(0, "?"), (1, "A")]


def test_audit_columns_of_the_mapping_are_ignored_and_placed_after_the_key(spark):
    df = spark.sql("select 1 as a, 2 as b, 3 as c")
    mapping = Mapping(
        "t",
        "s",
        (
            Field("a", pk=True),
            Field("b", pk=True),
            Field("dw_last_modified_dt", transformation="timestamp_ntz'1970-01-01'"),
            Field("c"),
        ),
        delta=Delta("src.a", "0"),
    )
    loaded = type1_full(mapping, {"s": df}, "2024-02-01 00:00:00")
    assert loaded.columns == ["a", "b", "dw_created_dt", "dw_last_modified_dt", "c"]
    assert loaded.first()["dw_last_modified_dt"] == ts("2024-02-01")
    plain = type1_full(mapping.with_(delta=None), {"s": df}, ts("2024-02-01"))
    assert plain.columns == ["a", "b", "dw_last_modified_dt", "c"]


def test_soft_deleted_rows(spark):
    """A deleted right row un-matches, a deleted or unflagged left row is dropped."""
    a = spark.sql("select * from values (1, 10, 'I'), (2, 20, 'D'), (3, 30, null), (4, 40, 'U') as t(id, ref, act)")
    b = spark.sql("select * from values (10, 'x', 'I'), (20, 'y', 'I'), (40, 'z', 'D') as t(id, code, act)")
    mapping = Mapping(
        "t",
        "a",
        (Field("id", pk=True), Field("code", source_table="b")),
        joins=(Join("b", [Condition(["src.ref", "b.id"]), Condition(["b.act", "'D'"], "!=")]),),
        where=(Condition(["src.act", "'D'"], "!="),),
    )
    loaded = run_load(mapping, {"a": a, "b": b}, "2024-02-01 00:00:00")
    assert rows(loaded, "id", "code") == [(1, "x"), (4, None)]


CONFIG = {
    "destination_table": "dim_offer",
    "target_type": "TYPE1",
    "driving_table": "ds.offer",
    "joins": [
        {
            "right": "ds.offer_type",
            "on": [
                {"operator": "=", "fields": ["ds.offer.type_id", "ds.offer_type.id"]},
                {"operator": "!=", "fields": ["ds.offer_type.act", "'D'"]},
            ],
        }
    ],
    "source_to_target": [
        {"name": "id", "source_column": "id", "is_primary_key": True, "data_type": "INTEGER", "is_nullable": False},
        {"name": "type", "source_column": "code", "source_name": "ds.offer_type", "pk": False},
        {"name": "label", "transformation": "upper(ds.offer_type.code)", "default": "'NONE'"},
    ],
    "delta": {"field": {"source_column": "changed"}, "lower_bound": "$TODAY", "upper_bound": 0},
    "write_disposition": "WRITE_TRUNCATE",
}


def test_config_with_qualified_names(spark):
    mapping = mapping_from_config(CONFIG)
    assert mapping.primary_keys == ["id"] and mapping.delta == Delta("src.changed", "$TODAY", 0)
    offers = spark.sql("select * from values (1, 5, timestamp_ntz'2024-01-30 01:00:00') as t(id, type_id, changed)")
    types = spark.sql("select * from values (5, 'gold', 'I') as t(id, code, act)")
    sources = {"ds.offer": offers, "ds.offer_type": types}
    loaded = run_load(mapping.with_(disposition=Disposition.TRANSIENT), sources, None, as_of=ts("2024-01-30"))
    assert rows(loaded) == [(1, "gold", "GOLD")]


def test_config_of_a_history():
    mapping = mapping_from_config(
        {
            "destination_table": "h",
            "target_type": "HISTORY",
            "driving_table": "ds.s",
            "source_to_target": [
                {"name": "key", "source_column": "id", "hk": True, "pk": True},
                {"name": "state", "source_column": "st"},
            ],
            "history": {
                "partition": [{"source_column": "id"}],
                "driving_column": [{"name": "state", "source_column": "st"}],
                "order": [
                    {"field": {"transformation": "ifnull(ds.s.a, ds.s.b)"}, "is_desc": True},
                    {"source_column": "id"},
                ],
            },
        }
    )
    order = (OrderKey("ifnull(src.a, src.b)", True), OrderKey("key"))
    assert mapping.history == History(["key"], ["state"], order)
    assert mapping.target_type is TargetType.HISTORY and mapping.history_keys == ["key"]


def test_unsupported_target_type():
    with pytest.raises(ValueError, match="TYPE3"):
        mapping_from_config({**CONFIG, "target_type": "TYPE3"})


def test_key_flags_count_by_value():
    fields = [{"name": "id", "source_column": "id", "pk": False, "is_primary_key": False}]
    assert mapping_from_config({**CONFIG, "source_to_target": fields}).primary_keys == []


def test_target_schema_of_a_history():
    fields = (
        Field("key", "INTEGER", pk=True, hk=True, nullable=False),
        Field("effective_from_dt", "TIMESTAMP", pk=True),
        Field("effective_from_dt_csn_seq", "INTEGER", pk=True),
        Field("effective_from_dt_seq", "INTEGER", pk=True),
        Field("state", "STRING"),
    )
    schema = target_schema(Mapping("h", "s", fields, TargetType.HISTORY), T.TimestampNTZType())
    assert schema.names == [
        "key",
        "effective_from_dt",
        "effective_from_dt_csn_seq",
        "effective_from_dt_seq",
        "dw_last_modified_dt",
        "effective_to_dt",
        "state",
    ]
    assert schema["effective_to_dt"].dataType == T.TimestampNTZType()
    assert not schema["key"].nullable and schema["state"].nullable
    assert target_schema(Mapping("h", "s", fields, disposition=Disposition.TRANSIENT)) is None


def test_table_definition_round_trip():
    schema = target_schema(Mapping("t", "s", (Field("a", "INTEGER", nullable=False), Field("b", "BOOLEAN"))))
    assert table_definition(schema)[0] == {"name": "a", "type": "INTEGER", "mode": "required"}
    assert table_definition(schema)[-1] == {"name": "b", "type": "BOOLEAN", "mode": "nullable"}


def test_conform_fills_and_refuses(spark):
    df = spark.sql("select 1 as a, 'x' as extra")
    schema = T.StructType.fromDDL("b string, a bigint")
    assert conform(df, schema).first() == (None, 1)
    with pytest.raises(ValueError, match="missing"):
        conform(df, T.StructType([T.StructField("z", T.StringType(), False)]))


def test_load_of_an_unknown_join_type(spark):
    df = spark.range(1)
    mapping = Mapping("t", "s", (Field("id"),), joins=(Join("s", [Condition(["src.id", "s.id"])], "asof"),))
    with pytest.raises(ValueError, match="asof"):
        joined_sources(mapping, {"s": df})


def test_dispositions_of_a_load(spark):
    df = spark.range(3)
    mapping = Mapping("t", "s", (Field("id", pk=True),))
    run = "2024-02-01 00:00:00"
    once = run_load(mapping, {"s": df}, run)
    assert once.columns == ["id", "dw_last_modified_dt"] and once.count() == 3
    append = mapping.with_(disposition=Disposition.APPEND)
    assert run_load(append, {"s": df}, run, target=once).count() == 6
    assert run_load(mapping, {"s": df}, run, target=once).count() == 3
    transient = run_load(mapping.with_(disposition=Disposition.TRANSIENT), {"s": df}, run)
    assert transient.columns == ["id"]
    emptied = run_load(mapping.with_(disposition=Disposition.DELETE), {"s": df}, run, target=once)
    assert emptied.columns == once.columns and emptied.count() == 0
