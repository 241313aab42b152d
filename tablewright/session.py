"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package expects. Values that depend on the size of
#: the cluster (shuffle partitions, memory) are left to the submitter.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if what follows must then be shuffled again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a
    temporary folder, which would be unreachable for the executors of a cluster.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tablewright-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def filesystem(spark: SparkSession, path: str):
    """``path`` as its file system sees it, and the file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage(df: DataFrame, label: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Materialise ``df`` as a transient table in the shared folder.

    Use it where a result is read more than once or has to stay the same across
    re-computation; everything else is better left lazy. The files survive the
    loss of any executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
