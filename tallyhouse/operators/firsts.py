"""The first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; ties fall to the smallest remaining columns.

    The minimum of a struct is kept per map task, so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    found = df.groupBy(*keys).agg(best)
    return found.select(*[F.col(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])
