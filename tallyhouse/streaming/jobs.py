"""Streaming deduplication, windowed metrics and the insert-if-absent sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyhouse.functions.numbers import MONEY_TOTAL, money
from tallyhouse.operators.dedup import FINGERPRINT, fingerprint_table, new_records
from tallyhouse.operators.known import Store, known, remember
from tallyhouse.operators.load import append_if_absent, range_of
from tallyhouse.operators.staging import settled


def parquet_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table, a folder or one file, as a stream with the schema it has now."""
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{name}.parquet").schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # As a pattern, since the plain path of a single file is refused by the streaming source.
    return reader.parquet(f"{folder}/{name}.parque[t]")


def _zoned(stream: DataFrame, event_time: str) -> DataFrame:
    """Watermarks need a zoned timestamp. In a UTC session, which streams need, the clock reading stays."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp"))


def dedup_stream(
    stream: DataFrame, fingerprint: Column, event_time: str, delay: str, spread: int | None = None
) -> DataFrame:
    """First record per fingerprint within the watermark delay.

    State is bounded by the delay. Spark drops a record that comes later than the watermark, also if it is the first of
    its kind, and counts it in numRowsDroppedByWatermark; where none may be lost, use ``sink_new_records``. A hot fingerprint is first
    thinned out in ``spread`` separate partitions and only the survivors meet in one. The input
    split is part of the lane, so that even rows equal in all columns spread out.
    """
    if spread is None:
        spread = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = _zoned(stream, event_time).withColumn(FINGERPRINT, fingerprint).withWatermark(event_time, delay)
    if spread > 1:
        lane = F.pmod(F.xxhash64(F.spark_partition_id(), *stream.columns), F.lit(spread)).cast("int")
        marked = marked.withColumn("_lane", lane).dropDuplicatesWithinWatermark([FINGERPRINT, "_lane"]).drop("_lane")
    return marked.dropDuplicatesWithinWatermark([FINGERPRINT])


def windowed(
    stream: DataFrame, event_time: str, width: str, delay: str, keys: Sequence[str], figures: Sequence[Column]
) -> DataFrame:
    """Figures per tumbling window and key.

    In append mode a window comes out once the watermark has passed it; ``sink_windows`` also stores those still open.
    """
    grouped = (
        _zoned(stream, event_time)
        .withWatermark(event_time, delay)
        .groupBy(F.window(event_time, width).alias("window"), *keys)
        .agg(*figures)
    )
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def order_windows(orders: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return windowed(orders, "created_at", width, delay, ["status"], [
        F.count("*").alias("order_count"),
        F.sum(money(F.col("total_amount"))).cast(MONEY_TOTAL).alias("total_revenue"),
    ])


def payment_windows(payments: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    ok = F.col("status") == "success"
    return windowed(payments, "created_at", width, delay, ["payment_method"], [
        F.count("*").alias("transaction_count"),
        F.sum(money(F.col("amount"))).cast(MONEY_TOTAL).alias("total_amount"),
        F.count_if(ok).alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.avg(F.when(ok, F.col("processing_time_ms"))).alias("avg_processing_time"),
    ])


def notification_windows(notifications: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return windowed(notifications, "sent_at", width, delay, ["channel", "notification_type"], [
        F.count("*").alias("total_sent"),
        *[F.count(f"{step}_at").alias(step) for step in ("delivered", "opened", "clicked")],
    ])


def sink_new_records(
    stream: DataFrame, fingerprint: Column, row_id: str, path: str, checkpoint: str, store: Store | None = None
) -> DataStreamWriter:
    """Append the first record of each fingerprint, however late it comes.

    What is known lies in a store, beside the target if none is given, of which a batch reads little more than filters: see
    ``operators.known``. A batch that is replayed sees only earlier ones and writes its own part again, so nothing is lost
    or doubled.
    """
    store = store or Store(f"{path}_known")

    def load(batch: DataFrame, batch_id: int) -> None:
        before = known(fingerprint_table(batch, fingerprint), store, batch_id)
        new = settled(new_records(batch, fingerprint, row_id, before), "stream-new")
        new.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        remember(new.select(FINGERPRINT), store, batch_id)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)


def sink_windows(windows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Store every window as it changes, also while it is open: one part for each batch, read with ``latest_windows``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return windows.writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint)


def latest_windows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last state of each window and key that ``sink_windows`` has stored."""
    rows = spark.read.parquet(path)
    by = ["window_start", "window_end", *keys]
    rest = [c for c in rows.columns if c not in by and c != "batch"]
    last = rows.groupBy(*by).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*by, *(F.col("last").getField(c).alias(c) for c in rest))


def sink_if_absent(
    stream: DataFrame, path: str, key: Sequence[str], checkpoint: str, reach_by: str | None
) -> DataStreamWriter:
    """Append only absent keys. A batch that is replayed after a failure finds its rows already there.

    ``reach_by`` names a column of the key, usually its date: a batch then reads only the part
    of the table in its own range of that column, so batches do not slow down as the table grows. None has to be
    chosen: each batch then reads all keys of the table.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        if reach_by is None:
            append_if_absent(batch, path, key)
            return
        held = settled(batch, "stream-batch")  # computed once for its range and its rows
        append_if_absent(held, path, key, reach=range_of(held, reach_by))

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)


def sink_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def run_available(writer: DataStreamWriter) -> None:
    """Process everything there is, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()
