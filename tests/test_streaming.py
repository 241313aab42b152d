import json
import os
import pathlib

import pytest
from pyspark.sql import types as T

from tablewright.operators.current import latest_rows
from tablewright.plans.mapping import OrderKey
from tablewright.session import fresh_path
from tablewright.sinks import keyed
from tablewright.streaming.landing import landing_stream, stream_landing
from tablewright.streaming.tables import stream_checked, stream_current_view, stream_upsert
from tests.helpers import rows, same_rows, ts

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
RUN = "2024-02-01 00:00:00"


class Landing:
    """A landing folder; files get rising modification times."""

    def __init__(self, folder):
        self.folder, self.clock = pathlib.Path(folder), 1_700_000_000

    def put(self, name, *objects):
        path = self.folder / name
        path.write_text("\n".join(json.dumps(o) for o in objects) + "\n")
        self.clock += 60
        os.utime(path, (self.clock, self.clock))


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "landing").mkdir()
    return Landing(tmp_path / "landing")


@pytest.fixture
def paths(spark):
    return [fresh_path(spark, f"stream-{n}") for n in ("out", "checkpoint")]


def test_archive_grows_by_what_has_landed(spark, landing, paths):
    def run():
        stream_landing(spark, str(landing.folder), SCHEMA, *paths, token="team").awaitTermination()
        return rows(spark.read.parquet(paths[0]), "id", "file_name", "file_dt")

    landing.put("team_20240102.json", {"id": 1, "v": "a"})
    landing.put("league_20240102.json", {"id": 9, "v": "z"})
    first = (1, "team_20240102.json", ts("2024-01-02"))
    assert run() == [first]
    landing.put("team_20240103_0930.json", {"id": 2, "v": "b"}, {"id": 3, "v": "c"})
    name, at = "team_20240103_0930.json", ts("2024-01-03 09:30")
    assert run() == [first, (2, name, at), (3, name, at)]
    assert len(run()) == 3


def test_read_files_are_moved_away(spark, landing, paths, tmp_path):
    gone = tmp_path / "gone"
    gone.mkdir()
    for n in range(3):
        landing.put(f"team_2024010{n + 1}.json", {"id": n, "v": "a"})
        stream = stream_landing(
            spark, str(landing.folder), SCHEMA, *paths, clean="archive", clean_into=str(gone), files_per_batch=1
        )
        stream.awaitTermination()
    assert spark.read.parquet(paths[0]).count() == 3
    assert len(list(landing.folder.glob("*.json"))) < 3


def test_current_view_does_not_depend_on_arrival(spark, landing, paths):
    root, checkpoint = paths
    order = [OrderKey("file_dt", True), OrderKey("load_dt", True), OrderKey("v")]
    for name, *objects in (
        ("team_20240105.json", {"id": 1, "v": "new"}, {"id": 2, "v": "x"}),
        ("team_20240101.json", {"id": 1, "v": "late"}, {"id": 3, "v": "only"}),
        ("team_20240106.json", {"id": 2, "v": "z"}, {"id": 2, "v": "y"}),
        ("team_latest.json", {"id": 4, "v": "undated"}, {"v": "no id"}),
    ):
        landing.put(name, *objects)
    stream = landing_stream(spark, str(landing.folder), SCHEMA, files_per_batch=1)
    stream_current_view(stream, root, ["id"], checkpoint, order, buckets=3).awaitTermination()
    current = keyed.read_table(spark, root)
    assert rows(current, "id", "v") == [(1, "new"), (2, "y"), (3, "only"), (4, "undated"), (None, "no id")]
    archive, again = (fresh_path(spark, n) for n in ("archive", "checkpoint"))
    stream_landing(spark, str(landing.folder), SCHEMA, archive, again).awaitTermination()
    same_rows(current, latest_rows(spark.read.parquet(archive).drop("file_dt_day"), ["id"], order))


def test_upsert_is_not_repeated_with_the_batch(spark, landing, paths):
    root, checkpoint = paths
    target = T.StructType.fromDDL("id bigint, v string, dw_created_dt timestamp_ntz, dw_last_modified_dt timestamp_ntz")
    order = [OrderKey("v", True)]

    def run(checkpoint, run_ts):
        stream = spark.readStream.schema(SCHEMA).json(str(landing.folder))
        stream_upsert(stream, root, ["id"], order, run_ts, target, checkpoint, buckets=3).awaitTermination()
        return rows(keyed.read_table(spark, root))

    landing.put("1.json", {"id": 1, "v": "a"}, {"id": 1, "v": "b"}, {"id": 2, "v": "c"})
    first = run(checkpoint, RUN)
    assert first == [(1, "b", ts("2024-02-01"), ts("2024-02-01")), (2, "c", ts("2024-02-01"), ts("2024-02-01"))]
    landing.put("2.json", {"id": 2, "v": "A"}, {"id": 3, "v": "d"})
    second = run(checkpoint, "2024-02-02 00:00:00")
    assert second[0] == first[0]
    assert second[1:] == [
        (2, "A", ts("2024-02-01"), ts("2024-02-02")),
        (3, "d", ts("2024-02-02"), ts("2024-02-02")),
    ]
    # A batch that is run again, as after a failure before its commit, changes nothing.
    last = max((pathlib.Path(checkpoint.removeprefix("file:")) / "commits").glob("[0-9]*"))
    for file in (last, last.with_name(f".{last.name}.crc")):
        file.unlink()
    assert run(checkpoint, "2024-02-02 00:00:00") == second
    landing.put("3.json", {"v": "no id"})
    with pytest.raises(Exception, match="without a full key"):
        run(checkpoint, RUN)
    assert rows(keyed.read_table(spark, root)) == second


def test_batch_that_fails_its_check_is_not_published(spark, landing, paths):
    out, checkpoint = paths
    published = []

    def run():
        stream = spark.readStream.schema(SCHEMA).json(str(landing.folder))
        publish = lambda batch, batch_id: published.append((batch_id, batch.count()))
        stream_checked(stream.where("id > 0"), checkpoint, publish).awaitTermination()

    landing.put("1.json", {"id": 1, "v": "a"}, {"id": 0, "v": "b"})
    run()
    assert published == [(0, 1)]
    landing.put("2.json", {"id": 0, "v": "empty"})
    with pytest.raises(Exception, match="row_count"):
        run()
    assert published == [(0, 1)]
