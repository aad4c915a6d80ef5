"""Insert-if-absent loading into a parquet table.

A table is a folder with one writer at a time. Rows whose key is already there are left
out, so running a load again, or after a failure, adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.firsts import first_per_key


def existing(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table, or None when nothing has been loaded yet. With a given schema no file is opened to learn it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    # Names with these marks belong to unfinished writes and to Spark itself.
    loaded = any(entry.getPath().getName()[0] not in "_." for entry in files.listStatus(folder))
    if not loaded:
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def absent_rows(
    new: DataFrame, target: DataFrame | None, key: Sequence[str], reach: Column | None = None, unique: bool = False
) -> DataFrame:
    """One row per key of ``new`` whose key is not in ``target``. Rows with a NULL in the key have no key: see ``without_key``.

    ``reach`` limits the part of the target that can hold these keys, as a filter on its
    partition or key columns; without it the key columns of the whole target are read.
    ``unique`` says that ``new`` has each key once, as the result of a grouping by it has.
    """
    rest = [c for c in new.columns if c not in key]
    new = new.filter(~_no_key(key))
    if unique:
        first = new
    else:
        first = first_per_key(new, key, rest) if rest else new.distinct()
    if target is None:
        return first
    held = target.filter(reach) if reach is not None else target
    # A partition column is read back with a guessed type, so keys are compared in the new rows' types.
    held = held.select(*[F.col(c).cast(new.schema[c].dataType).alias(f"_held_{c}") for c in key])
    match = [F.col(c) == F.col(f"_held_{c}") for c in key]
    return first.join(held, match, "left_anti")


def _no_key(key: Sequence[str]) -> Column:
    found = F.lit(False)
    for c in key:
        found = found | F.col(c).isNull()
    return found


def without_key(new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that cannot be loaded, as a part of their key is NULL: nothing tells them from each other or from what is there."""
    return new.filter(_no_key(key))


def range_of(df: DataFrame, column: str) -> Column:
    """A filter for the range a column spans in a frame: one aggregated row comes to the driver.

    As ``reach`` it is right when rows with equal keys have equal values in the column, for
    example because it belongs to the key.
    """
    # The bounds travel as text: cast back in the same session they are the same values, while a
    # zoned timestamp would come to Python in the zone of the driver's machine.
    low, high, nulls = df.agg(
        F.min(column).cast("string"), F.max(column).cast("string"), F.count_if(F.col(column).isNull())
    ).first()
    kind = df.schema[column].dataType
    inside = F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return inside | F.col(column).isNull() if nulls else inside


def append_if_absent(
    new: DataFrame,
    path: str,
    key: Sequence[str],
    partition_by: Sequence[str] = (),
    reach: Column | None = None,
    unique: bool = False,
) -> int:
    """Append the absent rows and return their number.

    The count is taken in the writing stage itself, so no second pass over the data is made.
    """
    counted = Observation()
    rows = absent_rows(new, existing(new.sparkSession, path), key, reach, unique)
    writer = rows.observe(counted, F.count("*").alias("rows")).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return int(counted.get["rows"])


def database_sink_options(url: str, table: str, rows_per_insert: int = 1000, connections: int = 8) -> dict[str, str]:
    """Options of a parallel database write with a bounded number of connections."""
    return {
        "url": url, "dbtable": table, "batchsize": str(rows_per_insert), "numPartitions": str(connections),
    }


def append_to_database(
    new: DataFrame, target: DataFrame, key: Sequence[str], reach: Column | None = None, **sink: Any
) -> int:
    """As ``append_if_absent``, for a database table: ``target`` is its split read, ``sink`` its write options."""
    counted = Observation()
    rows = absent_rows(new, target, key, reach).observe(counted, F.count("*").alias("rows"))
    rows.write.format("jdbc").options(**database_sink_options(**sink)).mode("append").save()
    return int(counted.get["rows"])
