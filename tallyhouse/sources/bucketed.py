"""Tables that joins and groupings by a key read without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyhouse.session import shared_folder


def bucketed(rows: DataFrame, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """Write rows to a table dealt to ``buckets`` by ``key``, and sorted by it in each; gives the table.

    Tables with the same number of buckets meet bucket by bucket. The table is known to the session's catalog, which may
    be that of the session alone; its files lie in the shared folder. A key that holds a large part of all rows makes
    one bucket large, so facts should be reduced by the key first, or joined the usual way.
    """
    spark = rows.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    # One file for each bucket: rows are dealt in the same way before they are written.
    placed = rows.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", shared_folder(spark, name)).mode("overwrite").saveAsTable(name)
    return spark.table(name)
