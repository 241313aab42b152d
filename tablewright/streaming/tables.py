"""Tables that follow a stream. The state is the table itself, so no row is too late.

Structured Streaming's checkpoint says which files are still to come; a batch that broke off is run again with
the same rows. Working a batch into a table twice gives the rows of working it in once, so nothing else is kept of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tablewright.operators.checks import check_row_count
from tablewright.operators.current import LATEST, latest_rows
from tablewright.operators.upsert import any_null
from tablewright.plans.mapping import OrderKey
from tablewright.session import filesystem, fresh_path
from tablewright.sinks.keyed import change_buckets, publish_upsert


def _each_batch(
    stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run ``work`` on every batch that is available, and stop.

    A batch is written to the shared folder first, and removed from there when
    done: it is read more than once, and work on the table then runs with
    adaptive execution.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        path = fresh_path(spark, f"batch-{batch_id}")
        try:
            batch.write.parquet(path)
            work(spark.read.schema(batch.schema).parquet(path), batch_id)
        finally:
            written, system = filesystem(spark, path)
            system.delete(written, True)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_current_view(
    stream: DataFrame,
    path: str,
    key: Sequence[str],
    checkpoint: str,
    order: Sequence[OrderKey] = LATEST,
    buckets: int | None = None,
) -> StreamingQuery:
    """Keep the current row of every key in a table that lies in buckets by key; null is a key, too.

    Rows compete by ``order``, not by arrival. The table keeps the lineage
    columns it needs for that.
    """
    schema = stream.schema

    def merge(state: DataFrame, new: DataFrame) -> DataFrame:
        # The batch is cut down to a row per key before it meets the table.
        return latest_rows(state.unionByName(latest_rows(new, key, order)), key, order)

    def work(batch: DataFrame, batch_id: int) -> None:
        change_buckets(path, batch, key, merge, schema, buckets, null_keys=True)

    return _each_batch(stream, checkpoint, work)


def stream_upsert(
    stream: DataFrame,
    path: str,
    pk: Sequence[str],
    order: Sequence[OrderKey],
    run_ts: str | datetime,
    schema: T.StructType,
    checkpoint: str,
    buckets: int | None = None,
) -> StreamingQuery:
    """Type-1 upsert of arrivals into a table that lies in buckets by key.

    Of several rows for one key in a batch the first by ``order`` counts. Rows without a full key match nothing: of
    a batch that is run again they would be there twice, so a stream with such rows fails.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        if not batch.where(any_null(pk)).isEmpty():
            raise ValueError(f"batch {batch_id} has rows without a full key ({', '.join(pk)})")
        publish_upsert(path, latest_rows(batch, pk, order), pk, run_ts, schema, buckets)

    return _each_batch(stream, checkpoint, work)


def stream_checked(
    stream: DataFrame,
    checkpoint: str,
    publish: Callable[[DataFrame, int], None],
    check: Callable[[DataFrame], DataFrame] = check_row_count,
) -> StreamingQuery:
    """Publish a batch only when it passes its check; the stream fails otherwise."""

    def work(batch: DataFrame, batch_id: int) -> None:
        failed = [row["check"] for row in check(batch).collect() if not row["result"]]
        if failed:
            raise ValueError(f"batch {batch_id} failed {', '.join(failed)}")
        publish(batch, batch_id)

    return _each_batch(stream, checkpoint, work)
