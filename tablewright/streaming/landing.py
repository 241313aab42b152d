"""Landing folders as streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tablewright.plans.delta import day_of
from tablewright.sinks.archive import FILE_DATE, with_day
from tablewright.sources.landing import route, stamp_lineage


def landing_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "json",
    token: str | None = None,
    multi_line: bool = False,
    files_per_batch: int | None = None,
    clean: str | None = None,
    clean_into: str | None = None,
) -> DataFrame:
    """New files of a landing folder as a stream, stamped with their lineage.

    ``token`` keeps the files of one feed. ``clean`` is what becomes of a file
    once it has been read: ``delete``, or ``archive`` to move it to ``clean_into``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("multiLine", multi_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if clean:
        reader = reader.option("cleanSource", clean)
    if clean_into:
        reader = reader.option("sourceArchiveDir", clean_into)
    rows = stamp_lineage(reader.load(folder))
    return route(rows, token) if token else rows


def stream_landing(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    archive: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Append what has landed since the last run to the archive, which lies in days of files, and stop.

    The file sink logs every batch, so a batch that is repeated after a failure
    is not appended twice.
    """
    rows = with_day(landing_stream(spark, folder, schema, **options))
    writer = rows.writeStream.partitionBy(day_of(FILE_DATE))
    writer = writer.format("parquet").option("path", archive).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
