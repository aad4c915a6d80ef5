"""The fixed lookups on users, orders, activity and payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import MONEY_TOTAL, mean_of_money, money
from tallyhouse.functions.time import Span

# Row limits of the two bounded lookups.
SEARCH_LIMIT = 100
ACTIVITY_LIMIT = 1000


def users_between(users: DataFrame, span: Span) -> DataFrame:
    """Users registered in the span, oldest first.

    The id as second key lets the sort cut through a moment many users share.
    """
    return (
        users.filter(span.holds(F.col("created_at")))
        .select("id", "email", "name", "created_at", "last_login_at", "status")
        .orderBy("created_at", "id")
    )


def orders_of_user(orders: DataFrame, user_id: int) -> DataFrame:
    """All orders of one user, newest first."""
    return (
        orders.filter(F.col("user_id") == user_id)
        .select("id", "user_id", "total_amount", "status", "created_at")
        .orderBy(F.desc("created_at"), F.desc("id"))
    )


def search_users(users: DataFrame, term: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """First users by id whose name or email contains the term, taken literally."""
    return (
        users.filter(F.contains(F.col("name"), F.lit(term)) | F.contains(F.col("email"), F.lit(term)))
        .select("id", "email", "name", "created_at")
        .orderBy("id")
        .limit(limit)
    )


def latest_activity(
    activity: DataFrame, user_id: int, activity_type: str, limit: int = ACTIVITY_LIMIT
) -> DataFrame:
    """Newest rows of one user and type. Sort and limit become one top-k per task."""
    return (
        activity.filter((F.col("user_id") == user_id) & (F.col("activity_type") == activity_type))
        .select("id", "user_id", "activity_type", "metadata", "created_at")
        .orderBy(F.desc("created_at"), F.desc("id"))
        .limit(limit)
    )


def _payment_figures() -> list[Column]:
    return [
        F.count("*").alias("total_transactions"),
        F.sum(money(F.col("amount"))).cast(MONEY_TOTAL).alias("total_amount"),
        mean_of_money(F.col("amount")).alias("avg_amount"),
        F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).alias("successful"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed"),
    ]


def payment_stats(payments: DataFrame, span: Span, merchant: str | int | None = None) -> DataFrame:
    """Payment figures of one merchant as one row, or of every merchant as one row each."""
    inside = payments.filter(span.holds(F.col("created_at")))
    if merchant is not None:
        wanted = F.lit(merchant).cast(payments.schema["merchant_id"].dataType)
        return inside.filter(F.col("merchant_id") == wanted).agg(*_payment_figures())
    return inside.groupBy("merchant_id").agg(*_payment_figures())
