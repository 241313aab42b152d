import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import session
from tablewright.operators.upsert import upsert
from tablewright.sinks import keyed, tables
from tests.helpers import rows, same_rows

OLD, RUN = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def test_create_only_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = T.StructType.fromDDL("a int, b string")
    assert tables.create_target(spark, path, schema)
    assert not tables.create_target(spark, path, T.StructType.fromDDL("z int"))
    assert tables.read(spark, path).schema == schema and tables.read(spark, path).count() == 0


def test_dispositions(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write(spark.sql("select 1 as a, 'x' as b"), path)
    tables.write(spark.sql("select 'y' as b, 2L as a, 3 as c"), path, "WRITE_APPEND")
    assert rows(tables.read(spark, path)) == [(1, "x"), (2, "y")]
    tables.write(spark.sql("select 5 as a"), path, "WRITETRUNCATE")
    assert rows(tables.read(spark, path)) == [(5, None)]
    tables.write(spark.sql("select 7 as other"), path, "WRITETRANSIENT")
    assert tables.read(spark, path).columns == ["other"]
    tables.write(spark.range(1), path, "DELETE")
    assert tables.read(spark, path).columns == ["other"] and tables.read(spark, path).count() == 0


def test_table_may_be_replaced_from_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write(spark.range(5), path)
    tables.write(tables.read(spark, path).where("id > 2"), path)
    assert rows(tables.read(spark, path)) == [(3,), (4,)]
    tables.write(spark.range(1), path)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v2", "v3"]


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.write(broken, path)
    assert tables.read(spark, path).count() == 5


def test_readers_see_the_old_rows_or_the_new(spark, tmp_path, monkeypatch):
    """Between the steps of a replacement the table is the old one, and looking at it changes nothing."""
    path, seen = f"{tmp_path}/t", []
    tables.write(spark.range(3), path)
    finished = tables.finished

    def look(spark, folder):
        mark = tmp_path / "t" / "v2" / "_SUCCESS"
        if mark.exists() and not seen:  # the files are there; as long as they are not marked
            mark.rename(tmp_path / "aside")
            seen.extend([tables.read(spark, path).count(), tables.exists(spark, path)])
            (tmp_path / "aside").rename(mark)
        return finished(spark, folder)

    monkeypatch.setattr(tables, "finished", look)
    old = tables.read(spark, path)
    tables.write(spark.range(10), path)
    assert seen == [3, True] and tables.read(spark, path).count() == 10
    assert old.count() == 3  # who began to read the table before still can


def test_replacement_that_broke_off_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write(spark.range(3), path)
    spark.range(10).write.parquet(f"{path}/v2")
    (tmp_path / "t" / "v2" / "_SUCCESS").unlink()
    assert tables.read(spark, path).count() == 3
    tables.write(spark.range(4), path, "WRITE_APPEND")
    assert tables.read(spark, path).count() == 7
    tables.write(spark.range(5), path)
    assert tables.read(spark, path).count() == 5


def test_plain_files_are_a_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    assert tables.exists(spark, path) and not tables.exists(spark, f"{tmp_path}/u")
    tables.write(spark.range(2), path, "WRITE_APPEND")
    assert tables.read(spark, path).count() == 5
    tables.write(tables.read(spark, path).where("id = 1"), path)
    assert rows(tables.read(spark, path)) == [(1,), (1,)]


@pytest.fixture
def path(spark):
    return session.fresh_path(spark, "test-table")


def state(spark, ids, name):
    stamp = F.lit(OLD).cast("timestamp_ntz")
    listed = spark.createDataFrame([(i, f"{name}{i}") for i in ids], "id int, name string")
    return listed.withColumns({"dw_created_dt": stamp, "dw_last_modified_dt": stamp})


def files(spark, path):
    """Files of a keyed table by bucket."""
    found = {}
    for name in keyed.read_table(spark, path).inputFiles():
        found.setdefault(name.split("/")[-2], set()).add(name)
    return found


def test_publish_replaces_and_may_read_itself(spark, path):
    with pytest.raises(ValueError, match="not been written"):
        keyed.read_table(spark, path)
    keyed.publish(state(spark, range(100), "a"), path, ["id"], buckets=4)
    keyed.publish(keyed.read_table(spark, path).where("id >= 40"), path, ["id"])
    assert keyed.read_table(spark, path).count() == 60
    assert keyed.read_table(spark, path).columns == ["id", "name", "dw_created_dt", "dw_last_modified_dt"]


def test_number_of_buckets_follows_from_bytes(spark, path, monkeypatch):
    assert [keyed.buckets_for(n << 30) for n in (0, 1, 2, 3, 9, 100_000)] == [1, 1, 2, 4, 16, 131072]
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 4000)
    target = state(spark, range(2000), "a")
    keyed.publish(target, path, ["id"])
    first = len(files(spark, path))
    assert first >= 4
    # A table that outgrows its buckets gets more of them.
    more = state(spark, range(2000, 20_000), "b")
    keyed.publish_upsert(path, more.select("id", "name"), ["id"], OLD, target.schema)
    assert len(files(spark, path)) >= 2 * first
    same_rows(keyed.read_table(spark, path), target.union(more))


def test_upsert_rewrites_touched_buckets_only(spark, path):
    target = state(spark, range(200), "a")
    keyed.publish(target, path, ["id"], buckets=16)
    before = files(spark, path)
    delta = spark.sql("select * from values (7, 'new7'), (1000, 'new1000') as t(id, name)")
    expected = upsert(target, delta, ["id"], RUN)
    assert keyed.publish_upsert(path, delta, ["id"], RUN, target.schema)
    after = files(spark, path)
    assert 14 <= sum(before[b] == after[b] for b in before) <= 15 and len(after) == 16
    same_rows(keyed.read_table(spark, path), expected)
    # The same change again gives the same rows.
    assert keyed.publish_upsert(path, delta, ["id"], RUN, target.schema)
    same_rows(keyed.read_table(spark, path), expected.withColumn("dw_created_dt", F.col("dw_created_dt")))


def test_upsert_into_a_new_table_and_of_nothing(spark, path):
    target = state(spark, range(3), "a")
    delta = target.select("id", "name")
    assert keyed.publish_upsert(path, delta, ["id"], OLD, target.schema)
    same_rows(keyed.read_table(spark, path), target)
    before = files(spark, path)
    assert not keyed.publish_upsert(path, delta.limit(0), ["id"], RUN, target.schema)
    assert files(spark, path) == before


def test_rows_without_a_key(spark, path):
    target = state(spark, range(3), "a")
    keyed.publish(target, path, ["id"], buckets=4)
    delta = spark.sql("select cast(null as long) as id, concat('n', id) as name from range(50)")
    expected = target
    for _ in range(2):
        keyed.publish_upsert(path, delta, ["id"], RUN, target.schema)
        expected = upsert(expected, delta, ["id"], RUN)
    same_rows(keyed.read_table(spark, path), expected)
    assert len(files(spark, path)) == 4


def test_plain_table_becomes_keyed(spark, tmp_path):
    path, target = f"{tmp_path}/t", state(spark, range(30), "a")
    tables.write(target, path)
    delta = spark.sql("select 1 as id, 'b' as name")
    assert keyed.publish_upsert(path, delta, ["id"], RUN, target.schema)
    same_rows(tables.read(spark, path), upsert(target, delta, ["id"], RUN))


def test_failed_change_leaves_the_table(spark, path):
    target = state(spark, range(50), "a")
    keyed.publish(target, path, ["id"], buckets=4)
    delta = spark.sql("select 1 as id, 'b' as name")

    def fail(state, stage):
        return state.withColumn("name", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        keyed.change_buckets(path, delta, ["id"], fail, target.schema)
    same_rows(keyed.read_table(spark, path), target)

    def stray(state, stage):
        return target

    with pytest.raises(ValueError, match="none of its keys"):
        keyed.change_buckets(path, delta, ["id"], stray, target.schema)
    same_rows(keyed.read_table(spark, path), target)
    keyed.publish_upsert(path, delta, ["id"], RUN, target.schema)
    assert keyed.read_table(spark, path).where("name = 'b'").count() == 1


def test_change_that_broke_off_is_finished_by_the_next(spark, path, monkeypatch):
    target = state(spark, range(50), "a")
    keyed.publish(target, path, ["id"], buckets=4)
    first, second = (spark.sql(f"select {i} as id, 'b' as name") for i in (1, 2))
    with monkeypatch.context() as broken:
        broken.setattr(keyed, "finish_change", lambda spark, path: None)
        keyed.publish_upsert(path, first, ["id"], RUN, target.schema)
    same_rows(keyed.read_table(spark, path), target)
    keyed.publish_upsert(path, second, ["id"], RUN, target.schema)
    same_rows(keyed.read_table(spark, path), upsert(upsert(target, first, ["id"], RUN), second, ["id"], RUN))


def test_buckets_may_become_empty(spark, path):
    target = state(spark, range(50), "a")
    keyed.publish(target, path, ["id"], buckets=4)
    keys = target.select("id")
    change = lambda state, stage: state.join(stage, "id", "left_anti")
    for part in (keys.where("id % 2 = 0"), keys):
        assert keyed.change_buckets(path, part, ["id"], change, target.schema)
    assert keyed.read_table(spark, path).count() == 0
    assert keyed.read_table(spark, path).schema == target.schema
    keyed.publish_upsert(path, target.select("id", "name"), ["id"], OLD, target.schema)
    same_rows(keyed.read_table(spark, path), target)


def test_staged_table_stays_the_same(spark):
    df = spark.range(100).select("id", F.rand().alias("r"))
    staged = session.stage(df)
    same_rows(staged, staged.select("id", "r"))
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert staged.inputFiles()[0].startswith(f"file://{session.shared_dir(spark)}")
