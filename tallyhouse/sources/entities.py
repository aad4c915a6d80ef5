"""The shop's entities, derived from the generic test tables.

``customer`` and ``orders`` play users and orders, ``lineitem`` plays payments, order items
and refunds, ``events`` plays activity and notifications, ``documents`` holds contact data in
running text. Each function returns one lazy frame with the columns of both schema versions;
Catalyst reads only what a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import money
from tallyhouse.functions.secrets import user_token
from tallyhouse.functions.time import moment
from tallyhouse.sources.tables import parquet_table

# The salt of the stand-in tokens, and what the codes of the test tables stand for.
SALT = "stand-in-salt"
TIERS = {"BUILDING": "premium", "MACHINERY": "enterprise", "FURNITURE": "basic", "HOUSEHOLD": "free", "AUTOMOBILE": "gold"}
METHODS = {"A": "card", "N": "paypal", "R": "bank_transfer"}
CHANNELS = {"click": "email", "view": "sms", "purchase": "push", "signup": "in_app", "error": "webhook"}
ACTIVE_FROM, INACTIVE_FROM = "2001-02-01 00:00:00", "2000-09-01 00:00:00"


def _coded(column: Column, meaning: dict[str, str]) -> Column:
    picked = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, word in meaning.items():
        picked = picked.when(column == code, F.lit(word))
    return picked


def _pick(key: Column, words: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (key % len(words) + 1).cast("int"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer; registration and last activity come from the customer's orders."""
    seen = (
        parquet_table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("last_activity_at"))
    )
    key, last = F.col("c_custkey"), F.col("last_activity_at")
    tail = F.concat(
        F.lpad((key % 1000).cast("string"), 3, "0"), F.lit("-"), F.lpad((key % 10000).cast("string"), 4, "0")
    )
    verified = F.col("c_acctbal") > 0
    status = (
        F.when(last >= moment(ACTIVE_FROM), "active")
        .when(last >= moment(INACTIVE_FROM), "inactive")
        .when(last.isNotNull(), "churned")
        .otherwise("pending_verification")
    )
    tier = _coded(F.col("c_mktsegment"), TIERS)
    return parquet_table(spark, folder, "customer").join(seen, "c_custkey", "left").select(
        key.alias("id"),
        user_token(key, SALT).alias("user_token"),
        F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@shop.test")).alias("email"),
        F.concat(F.lit("+1-555-"), tail).alias("phone"),
        F.col("c_name").alias("name"),
        status.alias("status"),
        tier.alias("subscription_tier"),
        tier.alias("subscription_type"),
        verified.cast("int").alias("email_verified"),
        F.when(verified, F.col("created_at")).alias("email_verified_at"),
        "created_at",
        "last_activity_at",
        last.alias("last_login_at"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_code"),
        _pick(key, ["web", "mobile", "referral"]).alias("signup_source"),
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("event_type").alias("activity_type"),
        F.col("props").alias("metadata"),
        F.col("ts").alias("created_at"),
    )


def order_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen as activity: they span years, the events only one month."""
    return parquet_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("activity_type"),
        F.col("o_orderdate").alias("created_at"),
    )


def order_columns(orders: DataFrame) -> DataFrame:
    code, urgency = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    status = (
        F.when((code == "F") & urgency.isin("1", "2"), "delivered")
        .when(code == "F", "completed")
        .when((code == "P") & (urgency == "1"), "refunded")
        .when(code == "P", "cancelled")
        .when(urgency == "1", "confirmed")
        .when(urgency == "2", "processing")
        .when(urgency == "3", "shipped")
        .otherwise("pending")
    )
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        user_token(F.col("o_custkey"), SALT).alias("user_token"),
        F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("order_number"),
        money(F.col("o_totalprice")).alias("total_amount"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_columns(parquet_table(spark, folder, "orders"))


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice")).alias("unit_price"),
        money(money(F.col("l_extendedprice")) * F.col("l_quantity").cast("int")).alias("total_price"),
    )


def payment_columns(lines: DataFrame) -> DataFrame:
    """Payments with the card data a source system would still hold in clear text."""
    order_key = F.col("l_orderkey").cast("string")
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("user_id"),
        user_token(F.col("l_partkey"), SALT).alias("user_token"),
        F.col("l_suppkey").alias("merchant_id"),
        money(F.col("l_extendedprice")).alias("amount"),
        F.when(F.col("l_linestatus") == "F", "success").otherwise("failed").alias("status"),
        _coded(F.col("l_returnflag"), METHODS).alias("payment_method"),
        F.when(F.col("l_linenumber") < 7, F.concat(F.lit("4"), F.lpad(order_key, 15, "0"))).alias("card_number"),
        F.when(F.col("l_linenumber") != 6, F.concat(F.lit("Holder "), order_key)).alias("cardholder_name"),
        F.concat(F.lit("Street "), F.col("l_suppkey").cast("string")).alias("billing_address"),
        F.col("l_quantity").cast("int").alias("processing_time_ms"),
        F.col("l_shipdate").alias("created_at"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return payment_columns(parquet_table(spark, folder, "lineitem"))


def refunds(spark: SparkSession, folder: str) -> DataFrame:
    """Returned order lines."""
    return (
        parquet_table(spark, folder, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
            F.col("l_orderkey").alias("order_id"),
            money(F.col("l_extendedprice")).alias("amount"),
            F.col("l_shipdate").alias("created_at"),
        )
    )


def notification_columns(events: DataFrame) -> DataFrame:
    """Events as notifications: ``k`` in ``props`` decides how far each one got."""
    k = F.get_json_object("props", "$.k").cast("int")
    sent = F.col("ts")

    def after(reached: Column, seconds: Column) -> Column:
        return F.when(reached, sent + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")))

    status = (
        F.when(k >= 80, "clicked")
        .when(k >= 50, "opened")
        .when(k >= 10, "delivered")
        .when(k >= 5, "bounced")
        .otherwise("failed")
    )
    return events.withColumn("k", k).select(
        F.col("event_id").alias("id"),
        "user_id",
        user_token(F.col("user_id"), SALT).alias("user_token"),
        _coded(F.col("event_type"), CHANNELS).alias("channel"),
        _pick(F.col("user_id"), ["promotional", "order_shipped", "system_alert"]).alias("notification_type"),
        status.alias("status"),
        sent.alias("created_at"),
        sent.alias("sent_at"),
        after(F.col("k") >= 10, F.col("k")).alias("delivered_at"),
        after(F.col("k") >= 50, F.col("k") * 60).alias("opened_at"),
        after(F.col("k") >= 80, F.col("k") * 120).alias("clicked_at"),
        after(F.col("k") < 5, F.lit(1)).alias("failed_at"),
        F.col("k").alias("retry_count"),
        F.lit(3).alias("max_retries"),
    )


def notifications(spark: SparkSession, folder: str) -> DataFrame:
    return notification_columns(parquet_table(spark, folder, "events"))


# Rough shapes of contact data in running text.
EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_IN_TEXT = r"\+?[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
CARD_IN_TEXT = r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Every email, phone and card number of the whole document texts: the first of each in one row, then the second ones.

    A text without any gives one row; '' stands where there is none.
    """
    text = F.coalesce("text", F.lit(""))
    found = {
        # Looking for the sign first is much cheaper than the pattern, and most texts have none.
        "email": F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(EMAIL_IN_TEXT), 0)),
        "phone": F.regexp_extract_all(text, F.lit(PHONE_IN_TEXT), 0),
        "card_number": F.regexp_extract_all(text, F.lit(CARD_IN_TEXT), 0),
    }
    lists = [F.coalesce(c, F.array().cast("array<string>")).alias(n) for n, c in found.items()]
    rows = parquet_table(spark, folder, "documents").select(F.col("doc_id").alias("id"), *lists, F.col("source").alias("name"), "lang")
    last = F.greatest(F.lit(1), *(F.size(n) for n in found))
    rows = rows.withColumn("n", F.explode(F.sequence(F.lit(1), last)))
    each = [F.coalesce(F.try_element_at(n, F.col("n")), F.lit("")).alias(n) for n in found]
    return rows.select("id", F.col("n").cast("long").alias("n"), *each, "name", "lang")


# Fixed value: anything that may be meant as an address.
ADDRESS_LIKE = r"[^ \t\n\r]*@[^ \t\n\r]*"


def address_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of the texts with an at sign in it, well formed or not."""
    rows = parquet_table(spark, folder, "documents").filter(F.col("text").contains("@"))
    return rows.select(F.col("doc_id").alias("id"), F.explode(F.regexp_extract_all("text", F.lit(ADDRESS_LIKE), 0)).alias("email"))
