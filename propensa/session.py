"""Spark session settings and the shared work folder.

Intermediate results that are read more than once are written once to the
folder named by ``spark.checkpoint.dir``. A written table survives the loss of
executors, cuts the lineage, and gives Catalyst exact sizes to plan joins with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Shuffle sizing: a partition of this size sorts and aggregates within the memory of one task.
PARTITION_BYTES = 256 * 1024**2
MIN_PARTITIONS = 200


def size_settings(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Scan and shuffle partition settings for an input of the given size.

    The shuffle count is an upper start: adaptive execution merges small partitions.
    """
    partitions = max(MIN_PARTITIONS, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(
    app_name: str = "propensa", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the library relies on (UTC clock, fair pools, AQE, skew joins).

    ``input_bytes``, the size of the largest table to be read, sizes scans and shuffles.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.scheduler.mode": "FAIR",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **(size_settings(input_bytes) if input_bytes else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediates, taken from the session.

    ``spark.checkpoint.dir`` if set, else a folder in the warehouse, which all
    executors of a cluster share as well.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/propensa-work").rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let the iterative learners cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark))


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """New path in the shared folder, under the id of the application."""
    return f"{work_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
