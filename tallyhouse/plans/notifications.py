"""Notification analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import percent
from tallyhouse.functions.text import has_text
from tallyhouse.functions.time import Span, day, millis_between
from tallyhouse.operators.conform import value_or
from tallyhouse.operators.dedup import distinct_records

# Default channels, and the states of a notification.
DAILY_CHANNELS = ("email", "sms", "push")
DELIVERED = ("delivered", "opened", "clicked")
ENGAGED = ("opened", "clicked")
STEPS = ("total_sent", "delivered", "opened", "clicked")


def daily_notifications(
    notifications: DataFrame, span: Span, channels: Sequence[str] | None = None, ordered: bool = True
) -> DataFrame:
    """The funnel per day, channel and type, with bounces and failures where the source tells them."""
    wanted = span.holds(F.col("sent_at")) & F.col("channel").isin(*(channels or DAILY_CHANNELS))
    counts = [F.count("*").alias("total_sent")]
    counts += [F.count(f"{step}_at").alias(step) for step in STEPS[1:]]
    if "status" in notifications.columns:
        counts += [F.count_if(F.col("status") == s).alias(s) for s in ("bounced", "failed")]
    daily = (
        notifications.filter(wanted)
        .groupBy(day(F.col("sent_at")).alias("notification_date"), "channel", "notification_type")
        .agg(*counts)
    )
    return daily.orderBy("notification_date", "channel", "notification_type") if ordered else daily


def _rates(sent: Column, delivered: Column, opened: Column, clicked: Column) -> dict[str, Column]:
    return {
        "delivery_rate": percent(delivered, sent),
        "open_rate": percent(opened, delivered),
        "click_rate": percent(clicked, opened),
        "click_through_rate": percent(clicked, sent),
    }


def notification_metrics(daily: DataFrame, version: int = 2) -> DataFrame:
    """Distinct daily figures with the four rates; version 2 adds bounces and failures."""
    unique = distinct_records(daily)
    counts = [value_or(daily, step, F.lit(0)).cast("long") for step in STEPS]
    columns = [F.col("notification_date"), F.col("channel"), F.col("notification_type")]
    columns += [c.alias(step) for c, step in zip(counts, STEPS)]
    columns += [rate.alias(name) for name, rate in _rates(*counts).items()]
    if version >= 2:
        columns += [value_or(daily, c, F.lit(0)).cast("long").alias(c) for c in ("bounced", "failed")]
    return unique.select(*columns)


def channel_metrics(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per channel, and per value of ``by``, the summed funnel and the three rates of the sums; rows without channel are left out."""
    sums = (
        metrics.filter(has_text(F.col("channel")))
        .groupBy("channel", *by)
        .agg(*[F.sum(step).alias(step) for step in STEPS])
    )
    rates = _rates(*[F.col(step) for step in STEPS])
    return sums.select("channel", *STEPS, *[rates[r].alias(r) for r in ("delivery_rate", "open_rate", "click_rate")], *by)


def notification_flags(notifications: DataFrame) -> DataFrame:
    """Delivered, engaged and retryable, by status."""
    status = F.col("status")
    return notifications.withColumns({
        "is_delivered": F.coalesce(status.isin(*DELIVERED), F.lit(False)),
        "is_engaged": F.coalesce(status.isin(*ENGAGED), F.lit(False)),
        "can_retry": _retryable(),
    })


def notification_flags_v1(notifications: DataFrame) -> DataFrame:
    """Delivered, opened and clicked, by timestamp."""
    return notifications.withColumns({
        f"is_{step}": F.col(f"{step}_at").isNotNull() for step in ("delivered", "opened", "clicked")
    })


def _retryable() -> Column:
    failed = (F.col("status") == "failed") & (F.col("retry_count") < F.col("max_retries"))
    return F.coalesce(failed, F.lit(False))


def retry_queue(notifications: DataFrame) -> DataFrame:
    """Failed notifications with retries left."""
    return notifications.filter(_retryable())


def delivery_latency(notifications: DataFrame) -> DataFrame:
    return notifications.withColumn(
        "delivery_time_ms", millis_between(F.col("sent_at"), F.col("delivered_at"))
    )
