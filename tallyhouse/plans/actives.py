"""Active users by day, week and month from stored bitmaps, exact and mergeable.

Activity is reduced once to bitmaps of user ids by day, tier and range of ids. A longer period is the union of its days' bitmaps, so
no activity is read again, and activity that comes late, or twice, is merged by the same union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.time import day, month
from tallyhouse.operators.load import existing
from tallyhouse.operators.merge import periods_of, replace_partitions, rows_of
from tallyhouse.operators.staging import settled
from tallyhouse.plans.users import ENTERPRISE, PREMIUM

DAY, MONTH = "activity_date", "month"
KEYS = (MONTH, DAY, "tier", "bucket")


def daily_bitmaps(users: DataFrame, activity: DataFrame) -> DataFrame:
    """``month, activity_date, tier, bucket, users``: one bitmap for each range of 32,768 ids with any active user.

    Tiers are premium, enterprise and the rest, as users have them now. A hot user is one pair for each day before the join.
    """
    tier = F.when(F.col("subscription_tier").isin(PREMIUM, ENTERPRISE), F.col("subscription_tier")).otherwise("other")
    tiers = users.select(F.col("id").alias("user_id"), tier.alias("tier")).distinct()
    pairs = activity.select("user_id", day(F.col("created_at")).alias(DAY)).dropna().distinct()
    bits = pairs.join(tiers, "user_id").groupBy(DAY, "tier", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))
    return bits.select(month(F.col(DAY)).alias(MONTH), DAY, "tier", "bucket", "users")


def merge_actives(users: DataFrame, activity: DataFrame, path: str) -> int:
    """Take activity into the stored bitmaps; only its months are read and replaced. Gives their number."""
    spark, new = users.sparkSession, settled(daily_bitmaps(users, activity), "actives-new")
    months, before = periods_of(new, MONTH), existing(users.sparkSession, path)
    if before is not None and months:
        old = rows_of(before, MONTH, months).select(*new.columns)
        new = settled(old.unionByName(new).groupBy(*KEYS).agg(F.bitmap_or_agg("users").alias("users")), "actives-merged")
    if months:
        replace_partitions(new, path, MONTH)
    return len(months)


def actives(bitmaps: DataFrame, period: str) -> DataFrame:
    """``period_start, users, premium_users, enterprise_users`` by ``day``, ``week`` (from Monday) or ``month``."""
    start = F.col(DAY) if period == "day" else F.trunc(DAY, period)
    rows = bitmaps.select(start.alias("period_start"), "tier", "bucket", "users")

    def distinct(chosen: DataFrame, name: str) -> DataFrame:
        merged = chosen.groupBy("period_start", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        return merged.groupBy("period_start").agg(F.sum(F.bitmap_count("users")).alias(name))

    # A user may have had several tiers within a period, so the whole is a union of its own, not a sum of the tiers.
    found = distinct(rows, "users")
    for tier in (PREMIUM, ENTERPRISE):
        found = found.join(distinct(rows.where(F.col("tier") == tier), f"{tier}_users"), "period_start", "left")
    return found.na.fill(0, [f"{tier}_users" for tier in (PREMIUM, ENTERPRISE)])
