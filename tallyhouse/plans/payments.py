"""Payment analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import MONEY_TOTAL, money, percent
from tallyhouse.functions.time import Span, day
from tallyhouse.operators.conform import decimal_text, value_or
from tallyhouse.operators.dedup import distinct_records
from tallyhouse.operators.privacy import mask_payments, tokenize_payments

# States of a payment.
SETTLED = ("success", "captured")


def daily_payments(payments: DataFrame, span: Span, ordered: bool = True) -> DataFrame:
    """Payments per day and method; the mean processing time covers successes only."""
    ok = F.col("status") == "success"
    daily = (
        payments.filter(span.holds(F.col("created_at")))
        .groupBy(day(F.col("created_at")).alias("payment_date"), "payment_method")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(money(F.col("amount"))).cast(MONEY_TOTAL).alias("total_amount"),
            F.sum(F.when(ok, 1).otherwise(0)).alias("successful"),
            F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed"),
            F.avg(F.when(ok, F.col("processing_time_ms"))).alias("avg_processing_time"),
        )
    )
    return daily.orderBy("payment_date", "payment_method") if ordered else daily


def protect_payments(payments: DataFrame, mode: str, salt: str | bytes | None = None) -> DataFrame:
    """Card data out of single payments, by ``token`` or by ``mask``, before anything is counted."""
    if mode == "mask":
        return mask_payments(payments)
    if mode == "token":
        if salt is None:
            raise ValueError("token mode needs a salt")
        return tokenize_payments(payments, salt)
    raise ValueError(f"unknown mode {mode!r}")


def payment_metrics(daily: DataFrame) -> DataFrame:
    """Distinct daily figures with the success rate; rows with NULL amounts are left out."""
    unique = distinct_records(daily)
    zero = F.lit(0)
    done = value_or(daily, "successful", zero).cast("long")
    total = value_or(daily, "transaction_count", zero).cast("long")
    return unique.select(
        "payment_date",
        "payment_method",
        total.alias("transaction_count"),
        decimal_text(daily, "total_amount").alias("total_amount"),
        done.alias("successful_count"),
        value_or(daily, "failed", zero).cast("long").alias("failed_count"),
        percent(done, total).alias("success_rate"),
        F.col("avg_processing_time").alias("avg_processing_time_ms"),
    ).filter(F.col("total_amount").isNotNull())


def payment_flags(payments: DataFrame) -> DataFrame:
    """Successful and refundable as columns."""
    settled = F.coalesce(F.col("status").isin(*SETTLED), F.lit(False))
    return payments.withColumns({"is_successful": settled, "is_refundable": settled})
