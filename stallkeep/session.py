"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle behind it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Size of the pieces REBALANCE cuts large partitions of a written table into.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Checkpoints go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "stallkeep", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this library is tuned for.

    Shuffle partitions are left to the cluster (AQE coalesces them); pass
    ``**{"spark.sql.shuffle.partitions": "8"}`` for a local run.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is whatever the cluster names in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder: on a cluster such a folder
    would not be visible to the other machines.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="stallkeep-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a frame under the shared folder and read it back; its path is for ``release``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Free the disk of finished steps: scratch tables by path, and shuffle files nobody can read any more.

    Spark removes the shuffle files of a frame once the driver has collected it
    as garbage. A driver whose heap is not full may not do so during a whole
    run, and the files of every step stay until it ends.
    """
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    gc.collect()
    jvm.System.gc()
