"""The four analytics tables with late rows taken in, in batch and as streams.

`jobs` insert what is absent, so a day loaded before its last orders came keeps its figures. Here a batch of source rows,
of whatever days, is reduced to partial aggregates by day and key, which are kept; the figures of the months it touches are
computed anew from all parts of these months and replace them. Loading rows in any number of batches gives the same
tables as loading them at once, and loading a batch again, under its number, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyhouse.functions.numbers import MONEY_TOTAL, money
from tallyhouse.functions.time import day, month
from tallyhouse.operators.load import without_key
from tallyhouse.operators.merge import added_up, merge_least, replace_partitions, rows_of, store_parts
from tallyhouse.operators.staging import settled
from tallyhouse.plans import notifications as N
from tallyhouse.plans import orders as O
from tallyhouse.plans import payments as P
from tallyhouse.plans import users as U

#: The partition column of the tables.
MONTH = "month"


@dataclass(frozen=True)
class Increment:
    """A daily table: its keys, the day first, how source rows are reduced, and how metrics come from added-up parts."""

    table: str
    keys: tuple[str, ...]
    parts: Callable[[DataFrame], DataFrame]
    metrics: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Merged:
    """What a batch did to a table."""

    table: str
    batch: int
    months: int
    rows: int
    rejected: int


def _count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def order_parts(orders: DataFrame, statuses: Sequence[str] = O.DAILY_STATUSES) -> DataFrame:
    """Orders, their value, and orders with a value, by day and status."""
    amount = money(F.col("total_amount"))
    return orders.where(F.col("status").isin(*statuses)).groupBy(day(F.col("created_at")).alias("order_date"), "status").agg(
        F.count("*").alias("order_count"), F.sum(amount).alias("amount"), F.count(amount).alias("amounts"))


def _order_metrics(parts: DataFrame) -> DataFrame:
    count = F.nullif(F.col("amounts"), F.lit(0)).cast("decimal(20,0)")
    return O.order_metrics(parts.select(
        "order_date", "status", "order_count", F.col("amount").cast(MONEY_TOTAL).alias("total_revenue"),
        (F.col("amount").cast(MONEY_TOTAL) / count).cast("decimal(22,6)").alias("avg_order_value")))


def payment_parts(payments: DataFrame) -> DataFrame:
    """Counts, value, and times of successes, by day and method. No card column is read."""
    ok = F.col("status") == "success"
    took = F.when(ok, F.col("processing_time_ms").cast("long"))
    return payments.groupBy(day(F.col("created_at")).alias("payment_date"), "payment_method").agg(
        F.count("*").alias("transaction_count"), F.sum(money(F.col("amount"))).alias("total_amount"),
        _count_where(ok).alias("successful"), _count_where(F.col("status") == "failed").alias("failed"),
        F.sum(took).alias("time"), F.count(took).alias("times"))


def _payment_metrics(parts: DataFrame) -> DataFrame:
    mean = F.col("time").cast("double") / F.nullif(F.col("times"), F.lit(0)).cast("double")
    return P.payment_metrics(parts.select(
        "payment_date", "payment_method", "transaction_count", F.col("total_amount").cast(MONEY_TOTAL).alias("total_amount"),
        "successful", "failed", mean.alias("avg_processing_time")))


def notification_parts(notifications: DataFrame, channels: Sequence[str] = N.DAILY_CHANNELS) -> DataFrame:
    """The funnel by day, channel and type."""
    steps = [F.count(f"{step}_at").alias(step) for step in N.STEPS[1:]]
    ends = [_count_where(F.col("status") == s).alias(s) for s in ("bounced", "failed")]
    rows = notifications.where(F.col("channel").isin(*channels))
    return rows.groupBy(day(F.col("sent_at")).alias("notification_date"), "channel", "notification_type").agg(
        F.count("*").alias("total_sent"), *steps, *ends)


ORDERS = Increment("order_analytics", ("order_date", "status"), order_parts, _order_metrics)
PAYMENTS = Increment("payment_analytics", ("payment_date", "payment_method"), payment_parts, _payment_metrics)
NOTIFICATIONS = Increment(
    "notification_analytics", ("notification_date", "channel", "notification_type"), notification_parts, N.notification_metrics)


def merge_rows(increment: Increment, rows: DataFrame, warehouse: str, batch: int) -> Merged:
    """Take a batch of source rows into a table. Its number must belong to these rows alone.

    Metrics with a NULL in the key go to the table's rejects, as those of the jobs do.
    """
    path, of_month = f"{warehouse}/{increment.table}", month(F.col(increment.keys[0])).alias(MONTH)
    months = store_parts(increment.parts(rows).select("*", of_month), f"{path}_parts", MONTH, batch)
    if not months:
        return Merged(increment.table, batch, 0, 0, 0)
    stored = rows_of(rows.sparkSession.read.parquet(f"{path}_parts"), MONTH, months).drop(MONTH)
    metrics = settled(increment.metrics(added_up(stored, increment.keys)).select("*", of_month), increment.table)
    keyless = without_key(metrics, increment.keys)
    rejected = keyless.count()
    replace_partitions(metrics.dropna(subset=list(increment.keys)), path, MONTH)
    if rejected:
        replace_partitions(keyless, f"{path}_rejects", MONTH)
    return Merged(increment.table, batch, len(months), metrics.count() - rejected, rejected)


def merge_users(users: DataFrame, warehouse: str, as_of: datetime) -> int:
    """Take users into the user table, which is partitioned by the month of registration; gives the number of months replaced.

    Of records with one token the least stays, as in a run over all of them at once: the earliest registration first.
    """
    metrics = U.user_metrics(users, as_of).where("user_token IS NOT NULL AND registration_date IS NOT NULL")
    return merge_least(
        metrics.withColumn(MONTH, month(F.col("registration_date"))), f"{warehouse}/user_analytics", ["user_token"], MONTH)


def sink_merged(stream: DataFrame, increment: Increment, warehouse: str, checkpoint: str) -> DataStreamWriter:
    """Take every micro-batch into a table, however late its rows; one that is replayed replaces its own parts."""

    def load(batch: DataFrame, batch_id: int) -> None:
        merge_rows(increment, batch, warehouse, batch_id)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
