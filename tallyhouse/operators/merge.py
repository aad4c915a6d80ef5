"""Tables that take in late rows: partial aggregates that add up, and least records; only touched periods are replaced.

Partial aggregates of a batch lie in partitions by period and batch, so storing a batch again replaces its own parts and
counts nothing twice. Figures of a period are always computed from all its parts. A least record per key can be merged any
number of times by itself. Tables are partitioned by period, a date such as the first of the month: with a few
rows a day, a partition for each day would be thousands of tiny files. They have one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.firsts import first_per_key
from tallyhouse.operators.load import existing
from tallyhouse.operators.staging import settled

BATCH = "batch"


def replace_partitions(rows: DataFrame, path: str, *columns: str) -> None:
    """Write rows, replacing exactly the partitions that they have."""
    # Few files for each partition, but a large one is cut at run time.
    rows.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def periods_of(rows: DataFrame, period: str) -> list[date]:
    """The distinct periods: no more short rows than the calendar has."""
    return sorted(r[0] for r in rows.select(period).where(F.col(period).isNotNull()).distinct().collect())


def store_parts(parts: DataFrame, path: str, period: str, batch: int) -> list[date]:
    """Store the partial aggregates of a batch and give the periods they touch. Rows without a period are left out."""
    parts = settled(parts.where(F.col(period).isNotNull()), "parts")
    periods = periods_of(parts, period)
    if periods:
        replace_partitions(parts.withColumn(BATCH, F.lit(batch)), path, period, BATCH)
    return periods


def added_up(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial aggregates of the same keys as one: sums and counts add up."""
    sums = [c for c in parts.columns if c not in keys and c != BATCH]
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def rows_of(stored: DataFrame, period: str, periods: Sequence[date]) -> DataFrame:
    """The rows of some periods; partitions of others are not read."""
    return stored.where(F.col(period).isin(*periods))


def merge_least(new: DataFrame, path: str, key: Sequence[str], period: str) -> int:
    """Merge records into a table that has the least one per key (by its columns in their order); gives the number of periods replaced.

    A key may have been stored under another period, so the keys of the whole table are looked through, but
    whole records are read, and written, only for periods that change. Merging the same records again changes nothing.
    """
    spark, rest = new.sparkSession, [c for c in new.columns if c not in key]
    new = settled(first_per_key(new, key, rest), "least-new")
    held = existing(spark, path)
    periods = periods_of(new, period)
    if held is not None:
        others = held.select(*key, period).join(new.select(*key), list(key), "left_semi")
        periods = sorted({*periods, *periods_of(others, period)})
        old = rows_of(held, period, periods).select(*new.columns)
        new = settled(first_per_key(old.unionByName(new), key, rest), "least-merged")
    if not periods:
        return 0
    left = periods_of(new, period)
    if left:
        replace_partitions(new, path, period)
    for gone in set(periods) - set(left):
        # The last record of this period has moved to another one.
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{period}={gone.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(periods)
