"""JSON records without a schema: redaction and flattening at any depth, row by row, without a shuffle.

A record is a VARIANT. Each level is taken apart into its entries, and one expression stands for all entries of a level, so
the plan has DEEPEST levels, whatever the keys, which may differ in every row; a row is walked only as deep as it goes.
Text that is no JSON, or repeats a key, gives NULL: nothing unread is passed on.

Walking a record takes far longer than reading it, so a task for each split of a file can be few: ``spread`` deals rows out.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.privacy import REDACTED, SENSITIVE_PARTS

#: Containers deeper than this are redacted whole, and not flattened further: the analyzer resolves a level in a few of its
#: 100 rounds (spark.sql.analyzer.maxIterations).
DEEPEST = 16
ENTRY = "array<struct<key:string,value:variant>>"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key over the shuffle's partitions, in place of those of the files."""
    return df.repartition(F.col(f"`{key}`"))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression over a value that stands in the plan once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _fields(value: Column) -> Column:
    """The entries of an object; NULL for anything else."""
    return F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")).cast(ENTRY)


def _items(value: Column) -> Column:
    """The values of an array; NULL for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def _entries(value: Column) -> Column:
    """Key and value of each entry of an object, or of an array, whose keys are NULL; NULL for anything else."""
    listed = F.transform(_items(value), lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")))
    return F.coalesce(_fields(value), listed.cast(ENTRY))


def _sensitive(key: Column, parts: Collection[str]) -> Column:
    if not parts:
        return F.lit(False)
    return F.coalesce(F.lower(key).rlike("|".join(rf"\Q{part}\E" for part in parts)), F.lit(False))


def sanitize_json(df: DataFrame, column: str, parts: Collection[str] = SENSITIVE_PARTS) -> DataFrame:
    """Redact the value of every key that contains a sensitive part, in objects and arrays at any depth; keys come out sorted."""
    mark = F.lit(REDACTED).cast("variant")

    def walk(value: Column, levels: int) -> Column:
        if not levels:
            return F.when(_entries(value).isNotNull(), mark).otherwise(value)
        cleaned = F.transform(_entries(value), lambda e: F.struct(
            e["key"].alias("key"), F.when(_sensitive(e["key"], parts), mark).otherwise(walk(e["value"], levels - 1)).alias("value")))
        # What has no entries stays as it is: values, and empty containers.
        return _once(cleaned, lambda c: F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, value).when(
            c[0]["key"].isNotNull(), F.to_variant_object(F.map_from_entries(c))).otherwise(F.transform(c, lambda e: e["value"]).cast("variant")))

    return df.withColumn(column, F.to_json(_once(F.try_parse_json(F.col(f"`{column}`")), lambda record: walk(record, DEEPEST))))


def flatten_json(df: DataFrame, column: str, separator: str = "_") -> DataFrame:
    """A row for each value that is no object, with its joined ``path`` and its ``value`` as text, in place of the column.

    Arrays are values, as JSON. A record without any value has no row.
    """

    def walk(value: Column, path: Column, levels: int) -> Column:
        leaf = F.array(F.struct(path.alias("path"), value.alias("value")))
        if not levels:
            return leaf
        below = F.flatten(F.transform(_fields(value), lambda e: _once(
            F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit(separator), e["key"])), lambda longer: walk(e["value"], longer, levels - 1))))
        return F.coalesce(below, leaf)

    leaves = _once(F.try_parse_json(F.col(f"`{column}`")), lambda record: walk(record, F.lit(""), DEEPEST))
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    rows = df.select(*rest, F.explode(leaves).alias("_leaf"))
    text = F.when(_entries(F.col("_leaf.value")).isNotNull(), F.to_json("_leaf.value")).otherwise(F.col("_leaf.value").cast("string"))
    return rows.where(F.col("_leaf.value").isNotNull()).select(*rest, F.col("_leaf.path").alias("path"), text.alias("value"))
