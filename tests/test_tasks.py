import json
from datetime import datetime

import pytest

from tablewright.operators.current import latest_rows
from tablewright.plans.config import mapping_from_config
from tablewright.plans.loads import scd2_full
from tablewright.plans.mapping import OrderKey
from tablewright.plans.tasks import build_table, check_table, current_table, load_files, run_build
from tablewright.sinks import tables
from tests.helpers import rows, ts

NOW = "2024-02-01 00:00:00"


def test_load_of_files(spark, tmp_path):
    (tmp_path / "fixtures_1.csv").write_text("id,name\n1,a\n2,b\n")
    (tmp_path / "fixtures_2.csv").write_text("id,name\n3,c\n")
    definition = tmp_path / "fixtures.json"
    definition.write_text(json.dumps([{"name": "id", "type": "INTEGER"}, {"name": "name", "type": "STRING"}]))
    parameters = {"source_objects": ["fixtures*.csv"], "schema_object": str(definition)}
    assert rows(load_files(spark, parameters, str(tmp_path))) == [(1, "a"), (2, "b"), (3, "c")]
    one = {**parameters, "source_objects": ["fixtures_2.csv", "fixtures_2.csv"], "skip_leading_rows": "0"}
    with pytest.raises(Exception, match="MALFORMED"):
        load_files(spark, one, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="source objects"):
        load_files(spark, {**parameters, "source_objects": []}, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        load_files(spark, {**parameters, "schema_object": "/none.json"}, str(tmp_path))


def test_table_by_sql_text_and_file(spark, tmp_path):
    sources = {"numbers": spark.range(6)}
    text = "select {KEY} from {numbers} where id >= :low"
    parameters = {"sql": text, "params": {"KEY": ["id"], "low": 4}}
    assert rows(build_table(spark, parameters, sources, NOW)) == [(4,), (5,)]
    path = tmp_path / "t.sql"
    path.write_text(text)
    assert rows(build_table(spark, {**parameters, "sql": str(path)}, sources, NOW)) == [(4,), (5,)]


def test_table_by_mapping(spark):
    parameters = {
        "destination_table": "t",
        "driving_table": "numbers",
        "source_to_target": [{"name": "n", "source_column": "id", "pk": True}],
    }
    built = build_table(spark, parameters, {"numbers": spark.range(2)}, NOW)
    assert rows(built) == [(0, ts("2024-02-01")), (1, ts("2024-02-01"))]


def verdict(spark, tables, **parameters):
    return tuple(check_table(spark, parameters, tables, NOW).first())


def test_checks(spark):
    df = spark.sql(
        """select k, v, cast(d as timestamp_ntz) as d, timestamp_ntz'2999-12-31 23:59:59' as effective_to_dt
           from values (1, 'a', '2024-01-01'), (1, 'a', '2024-01-03'), (2, 'b', '2024-01-03') as t(k, v, d)"""
    )
    tables = {"t": df, "none": df.limit(0)}
    assert verdict(spark, tables, sql="select count(*) from {t}") == ("query", True, 0)
    assert verdict(spark, tables, sql="select count(*) from {none}") == ("query", False, 1)
    assert verdict(spark, tables, sql="select k from {none}") == ("query", False, 1)
    assert verdict(spark, tables, sql="select true, null, '', 'x', 0.0, current_date()")[1:] == (False, 3)
    assert verdict(spark, tables, check="row_count", params={"FROM": "t"})[1]
    assert verdict(spark, tables, check="duplicate_records", params={"FROM": "t", "KEY": "k, d"})[1]
    assert not verdict(spark, tables, check="duplicate_records", params={"FROM": "t", "KEY": ["k"]})[1]
    assert not verdict(spark, tables, check="open_history_items", params={"FROM": "t", "KEY": "k"})[1]
    given = {"FROM": "t", "CHECK_FIELD": "v", "DATE_FIELD": "d"}
    assert verdict(spark, tables, check="new_value", params=given) == ("new_value", False, 1)
    with pytest.raises(ValueError, match="freshness"):
        verdict(spark, tables, check="freshness", params={"FROM": "t"})


ITEMS = {
    "destination_table": "t",
    "driving_table": "numbers",
    "source_to_target": [{"name": "n", "source_column": "id", "pk": True}],
}


def test_build_from_start_to_finish(spark, tmp_path):
    path, sources = str(tmp_path / "t"), {"numbers": spark.range(3)}
    verdicts = lambda found: {r["check"]: r["result"] for r in found.collect()}
    good = {"row_count": True, "duplicate_records": True}
    assert verdicts(run_build(spark, ITEMS, sources, path, NOW)) == good
    assert verdicts(run_build(spark, ITEMS, sources, path, NOW)) == good and tables.read(spark, path).count() == 3
    again = run_build(spark, {**ITEMS, "write_disposition": "WRITE_APPEND"}, sources, path, NOW)
    assert verdicts(again) == {"row_count": True, "duplicate_records": False}
    assert verdicts(run_build(spark, {**ITEMS, "block_data_check": True}, sources, path, NOW)) == {}
    assert verdicts(run_build(spark, {**ITEMS, "write_disposition": "DELETE"}, sources, path, NOW)) == {}
    assert tables.read(spark, path).count() == 0
    by_sql = {"destination_table": "u", "sql": "select * from {numbers} where id > 9"}
    assert verdicts(run_build(spark, by_sql, sources, str(tmp_path / "u"), NOW)) == {"row_count": False}


HISTORY = {
    "destination_table": "h",
    "target_type": "HISTORY",
    "driving_table": "log",
    "source_to_target": [
        {"name": "k", "source_column": "k", "pk": True, "hk": True},
        {"name": "effective_from_dt", "source_column": "at", "pk": True},
        {"name": "effective_from_dt_csn_seq", "transformation": "1", "pk": True},
        {"name": "effective_from_dt_seq", "transformation": "1", "pk": True},
        {"name": "v", "source_column": "v"},
    ],
    "history": {"partition": [{"name": "k"}], "driving_column": [{"name": "v"}]},
    "delta": {"field": {"source_column": "at"}, "lower_bound": "$TODAY", "upper_bound": 86400},
}
UPSERT = {
    "destination_table": "u",
    "driving_table": "log",
    "source_to_target": [{"name": "k", "source_column": "k", "pk": True}, {"name": "v", "source_column": "v"}],
    "delta": {"field": {"source_column": "at"}, "lower_bound": "$TODAY", "upper_bound": 86400},
}


@pytest.mark.parametrize("config", [HISTORY, UPSERT])
def test_incremental_tasks_leave_other_files(spark, tmp_path, config):
    """Day by day, only files of touched buckets change; in the end the table is what one load of all gives."""
    log = spark.sql(
        """select k, timestamp_ntz'2024-01-01' + make_dt_interval(d, k % 24) as at, (k * d) % 3 as v
           from (select id as k, explode(array(0, 1, 2)) as d from range(60)) where d = 0 or k % 20 = d"""
    )
    path, steps = str(tmp_path / "t"), []
    for day in (1, 2, 3):
        with pytest.MonkeyPatch.context() as patched:
            if day == 1:  # several buckets for few rows
                patched.setattr("tablewright.sinks.keyed.BUCKET_BYTES", 200)
            verdicts = run_build(spark, config, {"log": log}, path, NOW, datetime(2024, 1, day, 5))
        assert all(r["result"] for r in verdicts.collect())
        steps.append(set(tables.read(spark, path).inputFiles()))
    assert all(len(s) > 4 and s & t and s != t for s, t in zip(steps, steps[1:]))
    found = rows(tables.read(spark, path).drop("dw_created_dt", "dw_last_modified_dt"))
    if config is HISTORY:
        whole = mapping_from_config({**config, "delta": None})
        expected = rows(scd2_full(whole, {"log": log}, NOW).drop("dw_created_dt", "dw_last_modified_dt"))
    else:
        expected = rows(latest_rows(log, ["k"], [OrderKey("at", True)]).select("k", "v"))
    assert found == expected
    # A window without rows changes nothing; a first one makes an empty table.
    assert not run_build(spark, config, {"log": log}, path, NOW, datetime(2025, 1, 1)).where("check = 'row_count'").first()["n_failed"]
    assert set(tables.read(spark, path).inputFiles()) == steps[-1]
    empty = str(tmp_path / "empty")
    run_build(spark, config, {"log": log}, empty, NOW, datetime(2025, 1, 1))
    assert tables.read(spark, empty).columns == tables.read(spark, path).columns


def test_current_rows_from_parameters(spark):
    archive = spark.sql(
        """select v, a, 'f' as file_name, d as file_dt, d as load_dt
           from values (1, array('x', 'y'), 1), (2, array('y'), 2), (3, array(), 3) as t(v, a, d)"""
    )
    tables = {"arc": archive}
    plain = {"FROM": "arc", "KEY": "size(a)", "EXCLUDE": ",a"}
    assert rows(current_table({"params": plain}, tables)) == [(1,), (2,), (3,)]
    nested = {"FROM": "arc, unnest(a) letter", "KEY": "letter", "EXCLUDE": ",a"}
    assert rows(current_table({"params": nested}, tables)) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="FROM"):
        current_table({"params": {"FROM": "arc join other", "KEY": "v"}}, tables)
