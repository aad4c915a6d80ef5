"""User analytics: registrations, activity, churn, value segments, cohorts and daily actives.

Activity is always reduced to one row per user (and day, month or type) before it meets the
users, so a user who makes up a large part of all activity is combined on the map side and
never makes a join lopsided.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import MONEY_TOTAL, money
from tallyhouse.functions.secrets import email_token, name_token, phone_token
from tallyhouse.functions.time import Span, calendar_days, day, days_since, moment, month, whole_days
from tallyhouse.operators.dedup import distinct_records, duplicate_members

# Tiers with their own counts, user states and segment limits.
PREMIUM, ENTERPRISE = "premium", "enterprise"
CHURN_STATUSES_V1 = ("active", "churned", "dormant")
HIGH_FROM, MEDIUM_FROM, LOW_FROM = 10, 5, 1


def _since(df: DataFrame, start: datetime | None) -> DataFrame:
    return df if start is None else df.filter(F.col("created_at") >= moment(start))


def registrations(users: DataFrame, span: Span, with_enterprise: bool = True) -> DataFrame:
    """Registrations per day: all, verified, premium and (in the full form) enterprise."""
    counts = [
        F.count("*").alias("total_registrations"),
        F.count("email_verified_at").alias("verified_users"),
        F.count_if(F.col("subscription_tier") == PREMIUM).alias("premium_signups"),
    ]
    if with_enterprise:
        counts.append(F.count_if(F.col("subscription_tier") == ENTERPRISE).alias("enterprise_signups"))
    inside = users.filter(span.holds(F.col("created_at")))
    return inside.groupBy(day(F.col("created_at")).alias("registration_date")).agg(*counts).orderBy("registration_date")


def registrations_v1(users: DataFrame, span: Span) -> DataFrame:
    """As above on the older columns: a 0/1 verified flag and the subscription type."""
    inside = users.filter(span.holds(F.col("created_at")))
    return (
        inside.groupBy(day(F.col("created_at")).alias("registration_date"))
        .agg(
            F.count("*").alias("total_registrations"),
            F.count_if(F.col("email_verified") == 1).alias("verified_users"),
            F.count_if(F.col("subscription_type") == PREMIUM).alias("premium_signups"),
        )
        .orderBy("registration_date")
    )


def _activity_per_user(activity: DataFrame) -> DataFrame:
    return activity.groupBy("user_id").agg(
        F.count("id").alias("activity_count"), F.max("created_at").alias("last_activity")
    )


def user_activity(users: DataFrame, activity: DataFrame, registered_from: datetime) -> DataFrame:
    """Per active user: number of activities, the last one, and the sorted distinct types."""
    # Counting per type first keeps the wide pass a plain hash aggregate.
    per_type = activity.groupBy("user_id", "activity_type").agg(
        F.count("id").alias("n"), F.max("created_at").alias("last")
    )
    per_user = (
        per_type.groupBy("user_id")
        .agg(
            F.sum("n").alias("activity_count"),
            F.max("last").alias("last_activity"),
            F.array_sort(F.collect_set("activity_type")).alias("activity_types"),
        )
        .filter(F.col("activity_count") > 0)
    )
    chosen = _since(users, registered_from).select(F.col("id").alias("user_id"), "user_token")
    return chosen.join(per_user, "user_id")


def user_activity_v1(users: DataFrame, activity: DataFrame, registered_from: datetime, salt: str) -> DataFrame:
    """Activity per person, as told apart by email and name; both leave as tokens."""
    chosen = _since(users, registered_from).select(F.col("id").alias("user_id"), "email", "name")
    joined = chosen.join(_activity_per_user(activity).filter(F.col("activity_count") > 0), "user_id")
    per_person = joined.groupBy("email", "name").agg(
        F.sum("activity_count").alias("activity_count"), F.max("last_activity").alias("last_activity")
    )
    return per_person.select(
        email_token(F.col("email"), salt).alias("email_token"),
        name_token(F.col("name"), salt).alias("name_token"),
        "activity_count",
        "last_activity",
    )


def churn(users: DataFrame, statuses: Sequence[str], registered_from: datetime) -> DataFrame:
    """Per status: users, mean and exact median of the whole days from registration to last activity.

    Users are counted per status and day number first. The median then works on that short
    histogram, whose size depends on the calendar and not on the number of users.
    """
    chosen = _since(users, registered_from).filter(F.col("status").isin(*statuses))
    days = whole_days(F.col("last_activity_at"), F.col("created_at")).alias("days")
    histogram = chosen.groupBy("status", days).agg(F.count("*").alias("n"))
    known = F.when(F.col("days").isNotNull(), F.col("n"))
    return histogram.groupBy("status").agg(
        F.sum("n").alias("user_count"),
        (F.sum(F.col("days") * F.col("n")).cast("double") / F.sum(known)).alias("avg_days_active"),
        F.percentile("days", 0.5, F.col("n")).alias("median_days_active"),
    )


def churn_v1(
    users: DataFrame, registered_from: datetime, statuses: Sequence[str] = CHURN_STATUSES_V1
) -> DataFrame:
    """Per status: users and mean number of midnights between registration and last login."""
    return (
        _since(users, registered_from)
        .filter(F.col("status").isin(*statuses))
        .groupBy("status")
        .agg(
            F.count("*").alias("user_count"),
            F.avg(calendar_days(F.col("last_login_at"), F.col("created_at"))).alias("avg_days_active"),
        )
    )


def segment(order_count: Column) -> Column:
    """Value segment by number of orders."""
    return (
        F.when(order_count >= HIGH_FROM, "high_value")
        .when(order_count >= MEDIUM_FROM, "medium_value")
        .when(order_count >= LOW_FROM, "low_value")
        .otherwise("no_orders")
    )


def segment_v1(order_count: Column) -> Column:
    """The older segments, where no orders count as low value."""
    return (
        F.when(order_count >= HIGH_FROM, "high_value")
        .when(order_count >= MEDIUM_FROM, "medium_value")
        .otherwise("low_value")
    )


def order_totals(orders: DataFrame) -> DataFrame:
    """Number and sum of orders per user."""
    return orders.groupBy("user_id").agg(
        F.count("id").alias("total_orders"), F.sum(money(F.col("total_amount"))).cast(MONEY_TOTAL).alias("total_spend")
    )


def segments(users: DataFrame, totals: DataFrame, registered_from: datetime) -> DataFrame:
    """Users, mean orders, mean and total spend per value segment."""
    count = F.coalesce("total_orders", F.lit(0))
    spend = F.coalesce("total_spend", F.lit(0).cast(MONEY_TOTAL))
    chosen = _since(users, registered_from).select(F.col("id").alias("user_id"))
    per_user = chosen.join(totals, "user_id", "left").select(
        segment(count).alias("segment"), count.alias("orders"), spend.alias("spend")
    )
    revenue = F.sum("spend").cast(MONEY_TOTAL)
    return per_user.groupBy("segment").agg(
        F.count("*").alias("user_count"),
        F.avg("orders").alias("avg_orders"),
        (revenue.cast("double") / F.count("*")).alias("avg_spend"),
        revenue.alias("segment_revenue"),
    )


def segment_members(users: DataFrame, orders: DataFrame, registered_from: datetime, salt: str) -> DataFrame:
    """One row per person (email and phone, as tokens) with segment, orders and spend; spend NULL without orders."""
    chosen = _since(users, registered_from).select(F.col("id").alias("user_id"), "email", "phone")
    per_person = (
        chosen.join(order_totals(orders), "user_id", "left")
        .groupBy("email", "phone")
        .agg(
            F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
            F.sum("total_spend").cast(MONEY_TOTAL).alias("total_spend"),
        )
    )
    return per_person.select(
        segment_v1(F.col("total_orders")).alias("segment"),
        email_token(F.col("email"), salt).alias("email_token"),
        phone_token(F.col("phone"), salt).alias("phone_token"),
        "total_orders",
        "total_spend",
    )


def duplicate_identities(users: DataFrame) -> DataFrame:
    """Identity hashes shared by several users: a row for each of these users."""
    return duplicate_members(users, F.col("identity_hash"), "id", "identity_hash")


def duplicate_identities_v1(users: DataFrame) -> DataFrame:
    """As above by MD5 of the plain, unseparated contact data."""
    key = F.md5(F.concat_ws("", "email", "phone", "name"))
    return duplicate_members(users, key, "id", "user_hash")


def _user_months(activity: DataFrame) -> DataFrame:
    return activity.select("user_id", month(F.col("created_at")).alias("activity_month")).distinct()


def _cohorts(users: DataFrame, cohort_start: datetime, by_user: bool = False) -> DataFrame:
    """(user, registration month), shuffled by user, unless ``by_user`` says that the table is dealt by user already."""
    found = _since(users, cohort_start).select(
        F.col("id").alias("user_id"), month(F.col("created_at")).alias("cohort_month")
    )
    return found if by_user else found.repartition("user_id")


def retention(users: DataFrame, activity: DataFrame, cohort_start: datetime, by_user: bool = False) -> DataFrame:
    """Active users and their share of the cohort, per registration month and activity month.

    As in a plain join on the user, activity before the cohort's own month counts too. With ``by_user`` both tables are
    bucketed by user, and users are not shuffled before they meet.
    """
    # Ids hardly repeat, so one shuffle by user serves the count, the join and the cohort sizes.
    cohort = _cohorts(users, cohort_start, by_user).groupBy("user_id", "cohort_month").agg(F.count("*").alias("copies"))
    size = cohort.groupBy("cohort_month").agg(F.sum("copies").alias("size"))
    # (user, cohort month) and (user, activity month) are unique, so counting rows counts users.
    active = (
        cohort.join(_user_months(_since(activity, cohort_start)), "user_id")
        .groupBy("cohort_month", "activity_month")
        .agg(F.count("*").alias("active_users"))
    )
    share = F.col("active_users").cast("double") / F.nullif(F.col("size"), F.lit(0)) * 100
    return (
        active.join(size, "cohort_month")
        .select("cohort_month", "activity_month", "active_users", share.alias("retention_rate"))
        .orderBy("cohort_month", "activity_month")
    )


def cohort_activity(users: DataFrame, activity: DataFrame, cohort_start: datetime) -> DataFrame:
    """Active users per registration month and activity month; only registration is limited in time."""
    cohort = _cohorts(users, cohort_start).distinct()
    return (
        cohort.join(_user_months(activity), "user_id")
        .groupBy("cohort_month", "activity_month")
        .agg(F.count("*").alias("active_users"))
        .orderBy("cohort_month", "activity_month")
    )


def daily_active_users(users: DataFrame, activity: DataFrame, span: Span) -> DataFrame:
    """Distinct active users per day: all, premium and enterprise.

    Users and (user, day) pairs are made unique before the join, which leaves plain counts
    where three distinct counts would multiply every row.
    """
    tiers = users.groupBy(F.col("id").alias("user_id")).agg(
        F.max(F.coalesce(F.col("subscription_tier") == PREMIUM, F.lit(False))).alias("premium"),
        F.max(F.coalesce(F.col("subscription_tier") == ENTERPRISE, F.lit(False))).alias("enterprise"),
    )
    pairs = (
        activity.filter(span.holds(F.col("created_at")))
        .select("user_id", day(F.col("created_at")).alias("activity_date"))
        .distinct()
    )
    return (
        pairs.join(tiers, "user_id")
        .groupBy("activity_date")
        .agg(
            F.count("*").alias("dau"),
            F.count_if("premium").alias("premium_dau"),
            F.count_if("enterprise").alias("enterprise_dau"),
        )
        .orderBy("activity_date")
    )


# The columns of a user record that the two forms of the user job read.
RECORD = {
    1: ("id", "created_at", "status", "subscription_type", "email_verified", "last_login_at"),
    2: (
        "id", "user_token", "created_at", "status", "subscription_tier", "email_verified_at", "last_activity_at",
        "country_code", "signup_source",
    ),
}


def user_records(users: DataFrame, span: Span, version: int = 2) -> DataFrame:
    """The user job's extract: users registered in the span, no contact data."""
    return users.filter(span.holds(F.col("created_at"))).select(*RECORD[version])


def user_metrics(users: DataFrame, as_of: datetime) -> DataFrame:
    """One row per distinct user record, without contact data."""
    return distinct_records(users).select(
        "user_token",
        F.col("created_at").alias("registration_date"),
        "status",
        "subscription_tier",
        F.col("email_verified_at").isNotNull().alias("email_verified"),
        days_since(F.col("last_activity_at"), as_of).alias("days_since_last_activity"),
        "country_code",
        "signup_source",
    )


def user_metrics_v1(users: DataFrame, as_of: datetime) -> DataFrame:
    """The older form, keyed by user id."""
    return distinct_records(users).select(
        F.col("id").alias("user_id"),
        F.col("created_at").alias("registration_date"),
        "status",
        "subscription_type",
        F.coalesce(F.col("email_verified").cast("boolean"), F.lit(False)).alias("email_verified"),
        days_since(F.col("last_login_at"), as_of).alias("days_since_last_login"),
    )


def user_flags(users: DataFrame) -> DataFrame:
    """Verified and premium as columns."""
    return users.withColumns({
        "is_verified": F.col("email_verified_at").isNotNull(),
        "is_premium": F.coalesce(F.col("subscription_tier").isin(PREMIUM, ENTERPRISE), F.lit(False)),
    })
