import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.dates import file_date
from tablewright.sources.landing import (
    read_csv,
    read_json,
    read_landing,
    route,
    source_format,
    stamp_lineage,
)
from tablewright.sources.schema import read_definition, schema_from_definition, spark_type
from tablewright.sources.sql import register_sources, run_sql, run_sql_file
from tests.helpers import rows, ts

# File names and the dates they carry.
NAMES = {
    "team_20220510_1200.json": "2022-05-10 12:00",
    "team_2022-05-10.json": "2022-05-10",
    "league_10-05-2022.json": "2022-05-10",
    "team_10-MAY-2022.json": "2022-05-10",
    "team_2022may10.json": "2022-05-10",
    "team_20220510_1745.json": "2022-05-10 17:45",
    "team_20220510_2359.json": "2022-05-10 23:59",
    "team_20220510_2460.json": "2022-05-10",
    "team_10.05.2022.2301.json": "2022-05-10 23:01",
    "TEAM.2022.DEC.31.json": "2022-12-31",
    "team_20240229.json": "2024-02-29",
    "team_20230229.json": None,
    "team_latest.json": None,
    "team_20221399.json": None,
    "": None,
}


def test_file_dates(spark):
    df = spark.createDataFrame([(n,) for n in [*NAMES, None]], "name string")
    found = {r[0]: r[1] for r in df.select("name", file_date(F.col("name"))).collect()}
    assert found == {**{n: d and ts(d) for n, d in NAMES.items()}, None: None}


CUSTOMER = [
    {"name": "file_name", "type": "STRING", "mode": "REQUIRED"},
    {"name": "file_dt", "type": "TIMESTAMP", "mode": "REQUIRED"},
    {"name": "load_dt", "type": "TIMESTAMP", "mode": "REQUIRED"},
    {"name": "customer_id", "type": "INTEGER"},
    {"name": "balance", "type": "FLOAT"},
    {"name": "segments", "type": "STRING", "mode": "REPEATED"},
    {
        "name": "orders",
        "type": "RECORD",
        "mode": "REPEATED",
        "fields": [
            {"name": "placed", "type": "DATE"},
            {"name": "lines", "type": "RECORD", "fields": [{"name": "part_ids", "type": "INTEGER", "mode": "REPEATED"}]},
        ],
    },
    {"name": "is_active", "type": "BOOLEAN", "mode": "NULLABLE"},
]


def test_schema_of_a_definition(tmp_path):
    schema = schema_from_definition(CUSTOMER)
    assert schema.simpleString() == (
        "struct<file_name:string,file_dt:timestamp,load_dt:timestamp,customer_id:bigint,balance:double,"
        "segments:array<string>,orders:array<struct<placed:date,lines:struct<part_ids:array<bigint>>>>,is_active:boolean>"
    )
    assert [f.nullable for f in schema.fields] == [False] * 3 + [True] * 5
    path = tmp_path / "customer.json"
    path.write_text(json.dumps(CUSTOMER))
    assert read_definition(str(path)) == schema == schema_from_definition(json.dumps(CUSTOMER))
    with pytest.raises(FileNotFoundError):
        read_definition(str(tmp_path / "none.json"))


def test_types_by_name():
    assert spark_type("integer") == T.LongType() and spark_type("decimal(5,2)") == T.DecimalType(5, 2)
    assert spark_type("TIMESTAMP", T.TimestampNTZType()) == T.TimestampNTZType()


@pytest.fixture
def landed(tmp_path):
    objects = {
        "team_20220510_1200.json": {"customer_id": 1, "orders": [{"placed": "2022-05-01", "lines": {"part_ids": [7]}}]},
        "team_latest.json": {"customer_id": 2, "file_dt": None},
        "league_10-05-2022.json": {"customer_id": 3},
        "x_team_2022-05-11.json": {"customer_id": 4, "file_name": "own", "load_dt": "2020-01-01T00:00:00Z"},
    }
    for name, content in objects.items():
        (tmp_path / name).write_text(json.dumps(content, indent=2))
        os.utime(tmp_path / name, (1_700_000_000, 1_700_000_000))
    return str(tmp_path)


def test_lineage_of_documents(spark, landed):
    """Pretty-printed objects, one per file; what a document says itself is kept."""
    schema = schema_from_definition(CUSTOMER)
    df = stamp_lineage(read_json(spark, f"{landed}/*.json", schema, multi_line=True))
    found = {r["customer_id"]: (r["file_name"], r["file_dt"], r["load_dt"]) for r in df.collect()}
    loaded = ts("2023-11-14 22:13:20")
    assert found == {
        1: ("team_20220510_1200.json", ts("2022-05-10 12:00"), loaded),
        2: ("team_latest.json", loaded, loaded),
        3: ("league_10-05-2022.json", ts("2022-05-10"), loaded),
        4: ("own", ts("2022-05-11"), ts("2020-01-01")),
    }
    assert rows(route(df, "team"), "customer_id") == [(1,), (2,)]


def test_lineage_is_added_when_there_is_no_column_for_it(spark, landed):
    df = stamp_lineage(read_json(spark, landed, T.StructType.fromDDL("customer_id bigint"), multi_line=True))
    assert df.columns == ["customer_id", "file_name", "file_dt", "load_dt"]
    assert df.where("file_name is null or file_dt is null or load_dt is null").count() == 0


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1}\n{"n": oops\n{"n": 3}\n')
    schema = T.StructType.fromDDL("n bigint")
    kept = read_json(spark, str(tmp_path), schema, keep_corrupt=True)
    assert rows(kept) == [(1, None), (3, None), (None, '{"n": oops')]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json(spark, str(tmp_path), schema).collect()


@pytest.mark.parametrize("skip", [0, 1, 3])
@pytest.mark.parametrize("sep", [",", "|"])
def test_csv_with_leading_rows(spark, tmp_path, skip, sep):
    schema = T.StructType.fromDDL("id bigint, name string, amount double")
    for file in range(3):
        lines = [f"leading{sep}{i}" for i in range(skip)]
        lines += [f'{file * 10 + i}{sep}"n{sep}{i}"{sep}{i}.5' for i in range(4)]
        (tmp_path / f"f{file}.csv").write_text("\n".join(lines) + "\n")
    found = read_csv(spark, f"{tmp_path}/*.csv", schema, sep, skip)
    assert rows(found) == [(f * 10 + i, f"n{sep}{i}", i + 0.5) for f in range(3) for i in range(4)]


def test_leading_rows_of_split_files(spark, tmp_path):
    """Only the first block of a file has rows to skip."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    text = "head\n" * 2 + "\n".join(f"{i},x" for i in range(5000)) + "\n"
    (tmp_path / "big.csv").write_text(text)
    (tmp_path / "small.csv").write_text("head\nhead\n-1,y\n")
    (tmp_path / "short.csv").write_text("head\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = read_csv(spark, str(tmp_path), T.StructType.fromDDL("id bigint, s string"), skip_rows=2)
        assert sorted(r["id"] for r in found.collect()) == list(range(-1, 5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_format_by_extension(spark, tmp_path):
    assert source_format("a/team*.json") == "json" and source_format("x.PARQUET") == "parquet"
    with pytest.raises(ValueError):
        source_format("folder/file")
    spark.range(3).write.orc(f"{tmp_path}/t")
    assert read_landing(spark, f"{tmp_path}/t/*.orc", T.StructType.fromDDL("id bigint")).count() == 3
    assert read_landing(spark, f"{tmp_path}/t", T.StructType.fromDDL("id bigint"), fmt="ORC").count() == 3


def test_sql_with_parameters(spark, tmp_path):
    names = register_sources(spark, {"numbers": spark.range(10).selectExpr("id", "id % 3 as g")})
    assert names == ["numbers"]
    text = "select {KEY}, count(*) as n from IDENTIFIER(:t) where id >= :low group by {KEY}"
    given = {"params": {"t": "numbers", "low": 4}, "columns": {"KEY": ["g"]}}
    assert rows(run_sql(spark, text, **given)) == [(0, 2), (1, 2), (2, 2)]
    path = tmp_path / "q.sql"
    path.write_text(text)
    assert rows(run_sql_file(spark, str(path), **given)) == [(0, 2), (1, 2), (2, 2)]
    assert run_sql(spark, "select * from {numbers}", tables={"numbers": spark.range(2)}).count() == 2


def test_names_in_parameters_are_quoted(spark):
    register_sources(spark, {"one": spark.sql("select 1 as `a``; drop`")})
    assert run_sql(spark, "select {C} from one", columns={"C": ["a`; drop"]}).first()[0] == 1
