"""Intermediate tables on shared storage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import shared_folder

_WRITTEN: list[str] = []


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder now and read it back.

    It survives lost executors, later plans start from it, and Spark knows its real size: a
    join with it is broadcast when that size is under spark.sql.autoBroadcastJoinThreshold,
    and shuffled otherwise. This is a Spark job at the time of the call. The table stays until ``released``.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> int:
    """Delete the tables settled so far in this process, once no plan over them will run again; gives their number."""
    n = len(_WRITTEN)
    while _WRITTEN:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return n


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a job's shuffle files go when the job ends; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
