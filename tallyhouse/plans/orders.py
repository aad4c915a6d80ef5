"""Order analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import MONEY_TOTAL, mean_of_money, money
from tallyhouse.functions.time import Span, day
from tallyhouse.operators.conform import decimal_text, value_or
from tallyhouse.operators.dedup import distinct_records

# Default statuses of the daily figures, and the states of an order.
DAILY_STATUSES = ("completed", "pending", "cancelled")
COMPLETED = ("delivered",)
IN_PROGRESS = ("pending", "confirmed", "processing", "shipped")


def daily_orders(
    orders: DataFrame, span: Span, statuses: Sequence[str] | None = None, ordered: bool = True
) -> DataFrame:
    """Orders per day and status: count, revenue and mean value."""
    wanted = span.holds(F.col("created_at")) & F.col("status").isin(*(statuses or DAILY_STATUSES))
    daily = (
        orders.filter(wanted)
        .groupBy(day(F.col("created_at")).alias("order_date"), "status")
        .agg(
            F.count("*").alias("order_count"),
            F.sum(money(F.col("total_amount"))).cast(MONEY_TOTAL).alias("total_revenue"),
            mean_of_money(F.col("total_amount")).alias("avg_order_value"),
        )
    )
    return daily.orderBy("order_date", "status") if ordered else daily


def _figures(daily: DataFrame, revenue: Column, mean: Column) -> DataFrame:
    """Distinct rows with the given money columns; rows without readable money are left out."""
    figures = distinct_records(daily).select(
        "order_date",
        "status",
        value_or(daily, "order_count", F.lit(0)).cast("long").alias("order_count"),
        revenue.alias("total_revenue"),
        mean.alias("avg_order_value"),
    )
    return figures.filter(F.col("total_revenue").isNotNull() & F.col("avg_order_value").isNotNull())


def order_metrics(daily: DataFrame) -> DataFrame:
    """Distinct daily figures with money as exact decimal text."""
    return _figures(daily, decimal_text(daily, "total_revenue"), decimal_text(daily, "avg_order_value"))


def order_metrics_v1(daily: DataFrame) -> DataFrame:
    """Distinct daily figures with money as double."""
    def double(name: str) -> Column:
        return F.col(name).try_cast("double") if name in daily.columns else F.lit(0.0)

    return _figures(daily, double("total_revenue"), double("avg_order_value"))


def order_flags(orders: DataFrame) -> DataFrame:
    """Completed and in progress as columns."""
    return orders.withColumns({
        "is_completed": F.coalesce(F.col("status").isin(*COMPLETED), F.lit(False)),
        "is_active": F.coalesce(F.col("status").isin(*IN_PROGRESS), F.lit(False)),
    })
