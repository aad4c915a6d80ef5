"""Readers, and the two generic queries: parameterised SQL and a checked column/equality select."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_options(
    url: str,
    table: str,
    split_column: str,
    lower: Any,
    upper: Any,
    splits: int,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel database read.

    ``lower`` and ``upper`` only place the cuts; rows outside them are still read. Without
    a split column the whole table would come through one task, so it is required.
    """
    if not split_column or splits < 1:
        raise ValueError("a database read needs a split column and at least one split")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": split_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(splits),
        "fetchsize": str(fetch_rows),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        # Columns without zone stay without zone, as all time arithmetic here expects.
        "preferTimestampNTZ": "true",
    }


def jdbc_table(spark: SparkSession, url: str, table: str, **split: Any) -> DataFrame:
    """A database table read by several tasks; filters and simple aggregates are pushed down."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()


def _parameter(value: Any) -> Any:
    """Bind lists as arrays, and naive datetimes as text.

    Spark casts a text literal to the type of the column it meets; a datetime would become a
    zoned timestamp, and the column would be cast to it on every row instead.
    """
    if isinstance(value, (list, tuple, set, frozenset)):
        return F.array(*[F.lit(v) for v in value])
    if isinstance(value, datetime) and value.tzinfo is None:
        return value.isoformat(sep=" ")
    return value


def run_sql(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with named ``:params`` over ``{frames}``; values never become part of the text."""
    return spark.sql(text, args={k: _parameter(v) for k, v in (params or {}).items()}, **frames)


def select_where(
    df: DataFrame, columns: Sequence[str], equals: Mapping[str, Any] | None = None
) -> DataFrame:
    """Some columns of the rows where every given column equals its value.

    Names must exist in the schema. A value is cast to the type of its column, as an
    untyped SQL literal would be; None asks for NULL.
    """
    equals = equals or {}
    unknown = [c for c in (*columns, *equals) if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")

    def matches(name: str, value: Any) -> Column:
        if value is None:
            return F.col(name).isNull()
        return F.col(name) == F.lit(value).cast(df.schema[name].dataType)

    tests = [matches(name, value) for name, value in equals.items()]
    kept = df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
    return kept.select(*columns)
