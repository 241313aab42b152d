import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.operators import sizing
from tablewright.operators.upsert import classify, insert_new, update_from, upsert
from tablewright.plans.loads import type1_delta
from tablewright.plans.mapping import Delta, Field, Mapping
from tests.helpers import plan, rows, same_rows, ts

OLD, RUN = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def target(spark):
    df = spark.sql("select * from values (1, 'a', 10), (2, 'b', 20), (null, 'n', 0) as t(id, name, amount)")
    stamp = F.lit(OLD).cast("timestamp_ntz")
    return df.withColumns({"dw_created_dt": stamp, "dw_last_modified_dt": stamp}).cache()


@pytest.fixture(scope="module")
def delta(spark):
    return spark.sql("select * from values (2, 'B', 25), (3, 'C', 30), (null, 'N', 1) as t(id, name, amount)")


def test_insert_update_and_keep(target, delta):
    state = upsert(target, delta, ["id"], RUN)
    assert state.columns == target.columns
    assert rows(state) == [
        (1, "a", 10, ts(OLD), ts(OLD)),
        (2, "B", 25, ts(OLD), ts(RUN)),
        (3, "C", 30, ts(RUN), ts(RUN)),
        (None, "N", 1, ts(RUN), ts(RUN)),
        (None, "n", 0, ts(OLD), ts(OLD)),
    ]


def test_same_without_broadcast(target, delta, monkeypatch):
    """Beyond the size limit the sides are shuffled, and the rows are the same."""
    expected = upsert(target, delta, ["id"], RUN)
    monkeypatch.setattr(sizing, "fits_broadcast", lambda df, limit=0: False)
    monkeypatch.setattr("tablewright.operators.upsert.fits_broadcast", lambda df, limit=0: False)
    same_rows(upsert(target, delta, ["id"], RUN), expected)


def test_twice_is_once(target, delta):
    keyed = delta.where("id is not null")
    once = upsert(target, keyed, ["id"], RUN)
    same_rows(upsert(once, keyed, ["id"], RUN), once)


def test_empty_target_and_empty_delta(target, delta):
    assert upsert(target.limit(0), delta, ["id"], RUN).count() == 3
    same_rows(upsert(target, delta.limit(0), ["id"], RUN), target)


@pytest.mark.parametrize("empty", [True, False])
def test_key_twice_in_one_delta_fails(target, delta, empty):
    doubled = delta.unionAll(delta.where("id = 2"))
    with pytest.raises(PySparkException, match="more than one row for key"):
        upsert(target.limit(0) if empty else target, doubled, ["id"], RUN).count()


def test_rows_without_key_may_repeat(target, delta):
    doubled = delta.unionAll(delta.where("id is null"))
    assert upsert(target, doubled, ["id"], RUN).where("id is null").count() == 3


def test_needs_a_key(target, delta):
    with pytest.raises(ValueError, match="primary key"):
        upsert(target, delta, [], RUN)


def test_classes(target, delta):
    assert rows(classify(delta, target, ["id"]), "id", "row_action") == [(2, 2), (3, 1), (None, 1)]
    doubled = target.unionAll(target)
    assert classify(delta, doubled, ["id"]).count() == 3


def test_insert_only(target, delta):
    state = insert_new(target.select("id", "name", "amount"), delta, ["id"])
    assert rows(state, "id", "name") == [(1, "a"), (2, "b"), (3, "C"), (None, "N"), (None, "n")]


def test_update_from_with_expressions(target, delta):
    state = update_from(
        target, delta, ["id"], {"amount": "src.amount + trg.amount", "name": F.col("src.name")}, F.col("trg.amount") > 5
    )
    assert rows(state, "id", "name", "amount") == [(1, "a", 10), (2, "B", 45), (None, "n", 0)]


def test_update_from_of_several_rows(target, delta):
    """Many target rows may share a key; the source may not."""
    state = update_from(target.unionAll(target), delta, ["id"], {"amount": "src.amount"})
    assert rows(state.where("id = 2"), "amount") == [(25,), (25,)]
    with pytest.raises(PySparkException, match="source of the update"):
        update_from(target, delta.unionAll(delta), ["id"], {"amount": "src.amount"}).count()


def test_small_stage_leaves_the_target_unshuffled(spark, delta):
    target = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    target = target.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"))
    update = update_from(target, delta, ["id"], {"name": "src.name"})
    found = plan(update)
    assert "BroadcastHashJoin" in found and "SortMergeJoin" not in found


def test_measured_size(spark):
    small = spark.range(1000).selectExpr("id", "repeat('x', 100) as s")
    assert sizing.fits_broadcast(small) and sizing.fits_broadcast(small.limit(0))
    assert not sizing.fits_broadcast(small, 1000 * 100)
    nested = spark.range(10).selectExpr("array(named_struct('a', repeat('y', 1000))) as r")
    assert not sizing.fits_broadcast(nested, 10_000)


def test_load_by_delta(spark, target):
    source = spark.sql(
        """select * from values (1, 'z', 11, timestamp_ntz'2024-01-30 10:00:00'),
                                (2, 'y', 22, timestamp_ntz'2024-01-29 10:00:00') as t(id, name, amount, at)"""
    )
    fields = (Field("id", pk=True), Field("name"), Field("amount"))
    mapping = Mapping("t", "s", fields, delta=Delta("src.at", "$TODAY", 86400))
    state = type1_delta(mapping, {"s": source}, target, ts("2024-01-30"), RUN)
    assert rows(state, "id", "name") == [(1, "z"), (2, "b"), (None, "n")]
    with pytest.raises(ValueError, match="primary key"):
        keyless = mapping.with_(fields=(Field("id"), Field("name")))
        type1_delta(keyless, {"s": source}, target, ts("2024-01-30"), RUN)
