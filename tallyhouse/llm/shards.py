"""Contiguous shards of nearly equal bytes, cut from global prefix sums. Native: no Python in any task.

Rows are dealt to ranges of their order and written once, numbered within their range. Totals of the ranges, one
short row each, give the bytes and rows before every range, hence the ranges in which a shard ends; only
the rows of those are summed one by one, to find the row where it ends. Which shard a row belongs to, and its slot
there, then follow from its number, so texts are shuffled once, by the first step.

A row belongs to the shard in which the middle of its bytes lies, that is shard ``s`` of ``n`` holds the middles
from ``s / n`` to ``(s + 1) / n`` of all bytes: sizes differ by at most one longest row. Defined results: a null text has
the size 1; rows with equal keys are ordered by size and checksum, null keys first, and rows equal in these too are
dealt to several ranges, so no key has to fit one task; a row longer than a shard leaves others empty; columns may
have any names, as they travel inside ``row``; an empty table gives no rows. The rows should come from a table, so that
a repeated task reads them in the same order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.operators.staging import settled
from tallyhouse.session import shared_folder

SHARDS = 16
#: Spark numbers the rows of a partition in the low bits of ``monotonically_increasing_id``, which stay below this.
RANGE_ROWS = 1 << 33


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and one more for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    """Unsigned crc32 of a text in UTF-8."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def ranged(docs: DataFrame, order: Sequence[str], text: str = "text") -> DataFrame:
    """``row, size, range, place``: the rows in ranges of their order, written; ``place`` counts from 0 in each range."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    field = F.col("row").getField
    held = held.select("row", text_bytes(field(text)).alias("size"), text_crc32(field(text)).alias("crc"), F.rand(17).alias("salt"))
    by = [*map(field, order), F.col("size"), F.col("crc"), F.col("salt")]
    dealt = held.repartitionByRange(*by).sortWithinPartitions(*by).select("row", "size", F.monotonically_increasing_id().alias("at"))
    return settled(dealt.select(
        "row", "size", F.expr("cast(at div %d as int)" % RANGE_ROWS).alias("range"), (F.col("at") % RANGE_ROWS).alias("place"),
    ), "ranged")


def _shard_at(twice: str, shards: int) -> Column:
    """The shard that holds a point, given as twice the bytes before it."""
    return F.least(F.lit(shards - 1), F.expr(f"({twice}) * {shards} div (2 * total)")).cast("int")


def range_plan(rows: DataFrame, shards: int) -> DataFrame:
    """``range, rows_before, shard, first_row, cuts`` of each range.

    ``shard`` is that of its first row and ``first_row`` the row where this shard begins, over all rows; ``cuts`` lists the
    row and the shard of every later beginning within the range.
    """
    totals = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # One short row for each range: their number is that of the shuffle's partitions.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = settled(totals.select(
        "range", "bytes", "rows",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    ), "range-totals")
    totals = totals.withColumns({
        "low": _shard_at("2 * bytes_before", shards), "high": _shard_at("2 * (bytes_before + bytes)", shards),
    })
    cut = totals.where("low < high").select("range", "bytes_before", "rows_before", "total")
    inside = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.select("range", "place", "size").join(cut, "range").withColumn(
        "start", F.col("bytes_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    begins = summed.withColumn("shard", _shard_at("2 * start + size", shards)).groupBy("range", "shard").agg(
        F.min(F.col("rows_before") + F.col("place")).alias("first_row"))
    whole = totals.where("low = high").select("range", F.col("low").alias("shard"), F.col("rows_before").alias("first_row"))
    # The first row of a shard is the least over the ranges that hold rows of it.
    begins = begins.unionByName(whole).withColumn("first_row", F.min("first_row").over(Window.partitionBy("shard")))
    listed = begins.groupBy("range").agg(F.sort_array(F.collect_list(F.struct("first_row", "shard"))).alias("all"))
    return settled(totals.join(listed, "range").select(
        "range", "rows_before", F.col("all")[0]["shard"].alias("shard"), F.col("all")[0]["first_row"].alias("first_row"),
        F.slice("all", F.lit(2), F.size("all")).alias("cuts"),
    ), "range-plan")


def placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``row, size, shard, slot`` of each row; slots of a shard count from 0."""
    found = rows.join(plan, "range").withColumn("number", F.col("rows_before") + F.col("place"))
    begun = F.filter("cuts", lambda c: c["first_row"] <= F.col("number"))
    last = F.coalesce(F.try_element_at(begun, F.lit(-1)), F.struct("first_row", "shard"))
    found = found.withColumn("begun", last)
    return found.select(
        "row", "size", F.col("begun.shard").alias("shard"), (F.col("number") - F.col("begun.first_row")).alias("slot"))


def write_shards(docs: DataFrame, shards: int = SHARDS, order: Sequence[str] = ("doc_id",), text: str = "text", folder: str | None = None) -> str:
    """Write all rows to shards of a folder, ``shard=0`` and so on, and return it. Files hold their rows by slot."""
    folder = folder or shared_folder(docs.sparkSession, "shards")
    rows = ranged(docs, order, text)
    found = placed(rows, range_plan(rows, shards))
    found.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return folder


def read_shards(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """``row, size, slot, shard`` of all shards, or of none where there are no rows; ``like`` is a table with the columns of ``row``."""
    schema = like.select(
        F.struct(*(F.col(f"`{c}`") for c in like.columns)).alias("row"), F.lit(0).cast("long").alias("size"),
        F.lit(0).cast("long").alias("slot"), F.lit(0).alias("shard"),
    ).schema
    return spark.read.schema(schema).parquet(folder)
