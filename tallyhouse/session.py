"""Session settings and the durable folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 << 20


def shuffle_width(input_bytes: int) -> int:
    """Partitions that shuffles of this much data start with. AQE merges small ones, but never splits those of an aggregate."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "tallyhouse", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings every job here relies on.

    On a cluster the width of shuffles comes from ``input_bytes``, the size of the largest input of a job, or from
    spark.sql.adaptive.coalescePartitions.initialPartitionNum; small partitions are merged at run time. Streams keep
    spark.sql.shuffle.partitions, which is fixed for the life of a checkpoint.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Not recording where each column was written halves the time to build wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    wide = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if input_bytes is not None:
        spark.conf.set(wide, str(shuffle_width(input_bytes)))
    elif not spark.sparkContext.master.startswith("local") and spark.conf.get(wide, None) is None:
        raise ValueError(f"on a cluster give input_bytes, or set {wide}")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder: on a cluster other
    executors could not read it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
