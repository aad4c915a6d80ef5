"""Every operator as a query over the test tables: ``name -> (spark, folder) -> DataFrame``.

Queries run over whole tables. Money leaves as double or text, dates and arrays as text, so
that results compare the same way in any engine and client.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import secrets as S
from tallyhouse.functions.numbers import currency_text, divide_or
from tallyhouse.functions.text import is_email, shorten
from tallyhouse.functions.time import Span, day_before, hour_before
from tallyhouse.operators import conform as C
from tallyhouse.operators import dedup as D
from tallyhouse.operators import fingerprints as FP
from tallyhouse.operators import known as K
from tallyhouse.operators import privacy as PR
from tallyhouse.operators import proof as PF
from tallyhouse.operators import records as R
from tallyhouse.operators.load import append_if_absent
from tallyhouse.operators.merge import replace_partitions
from tallyhouse.plans import actives as A
from tallyhouse.plans import backfill as B
from tallyhouse.plans import increments as I
from tallyhouse.plans import jobs as J
from tallyhouse.plans import notifications as N
from tallyhouse.plans import orders as O
from tallyhouse.plans import payments as P
from tallyhouse.plans import users as U
from tallyhouse.session import shared_folder
from tallyhouse.sources import entities as E
from tallyhouse.sources import lookups as L
from tallyhouse.sources import search as X
from tallyhouse.sources.bucketed import bucketed
from tallyhouse.sources.clustered import write_clustered
from tallyhouse.sources.tables import parquet_table, run_sql, select_where
from tallyhouse.streaming import jobs as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVER = Span(datetime(1990, 1, 1), datetime(2030, 1, 1))
SINCE = datetime(1990, 1, 1)
AS_OF = datetime(2001, 8, 1, 12)
SALT = "catalog-salt"
STATUSES = ["active", "inactive", "churned"]


def query(function: Query) -> Query:
    """Register a query under its name, with dates as text."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = function(spark, folder)
        dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
        return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df

    QUERIES[function.__name__] = run
    return function


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- sources and lookups -------------------------------------------------------------------


@query
def param_scan(spark, folder):
    text = """
        SELECT l_returnflag, l_linestatus, count(*) AS line_count, sum(CAST(l_quantity AS BIGINT)) AS quantity
        FROM {lines}
        WHERE l_shipdate >= :start AND l_shipdate < :end AND array_contains(:flags, l_returnflag)
        GROUP BY l_returnflag, l_linestatus
    """
    params = {"start": datetime(1996, 1, 1), "end": datetime(2001, 1, 1), "flags": ["A", "R"]}
    return run_sql(spark, text, params, lines=parquet_table(spark, folder, "lineitem"))


@query
def users_by_range(spark, folder):
    return L.users_between(E.users(spark, folder), Span(datetime(1995, 6, 1), datetime(1997, 1, 1)))


@query
def orders_of_user(spark, folder):
    return _doubles(L.orders_of_user(E.orders(spark, folder), 42), "total_amount")


@query
def user_search(spark, folder):
    return L.search_users(E.users(spark, folder), "er.00000004")


USER_TEXTS = "id long, email string, name string, created_at timestamp_ntz"


def _searched(spark, folder, term):
    index = X.TextIndex(shared_folder(spark, "search"), ("name", "email"))
    X.build_index(E.users(spark, folder).select("id", "email", "name", "created_at"), index)
    return X.search(spark, index, term, USER_TEXTS, L.SEARCH_LIMIT)


@query
def user_search_of_index(spark, folder):
    return _searched(spark, folder, "er.00000004")


@query
def user_search_of_short_term(spark, folder):
    return _searched(spark, folder, "99")


@query
def orders_of_user_clustered(spark, folder):
    path = shared_folder(spark, "clustered")
    write_clustered(E.orders(spark, folder), path, ("user_id", "created_at", "id"))
    return _doubles(L.orders_of_user(spark.read.parquet(path), 42), "total_amount")


@query
def user_activity_clustered(spark, folder):
    """Activity lies by time, as it comes; the user is found by Bloom filters."""
    path = shared_folder(spark, "clustered")
    write_clustered(E.activity(spark, folder), path, ("created_at", "id"), ("user_id",))
    return L.latest_activity(spark.read.parquet(path), 42, "click")


@query
def user_activity_topk(spark, folder):
    return L.latest_activity(E.activity(spark, folder), 42, "click")


@query
def merchant_payment_stats(spark, folder):
    stats = L.payment_stats(E.payments(spark, folder), EVER)
    return _doubles(stats, "total_amount", "avg_amount")


@query
def dynamic_select(spark, folder):
    return select_where(
        E.orders(spark, folder), ["id", "user_id", "created_at"], {"status": "shipped"}
    )


# --- conformance ---------------------------------------------------------------------------


@query
def conform_users_v1(spark, folder):
    return C.conform(E.users(spark, folder), "user", 1).valid


@query
def conform_users_v2(spark, folder):
    return C.conform(E.users(spark, folder), "user", 2).valid.select(
        "id", "user_token", "status", "subscription_tier", "email_verified_at", "created_at", "last_activity_at",
        "signup_source", "country_code", "preferred_language",
    )


@query
def conform_activity_v1(spark, folder):
    return C.conform(E.activity(spark, folder), "activity", 1).valid.select(
        "id", "user_id", "activity_type", "metadata", "created_at"
    )


@query
def conform_activity_v2(spark, folder):
    rows = E.activity(spark, folder).withColumn("user_token", S.user_token(F.col("user_id"), SALT))
    return C.conform(rows, "activity", 2).valid.select("id", "user_id", "user_token", "activity_type", "created_at")


@query
def conform_orders_v1(spark, folder):
    return C.conform(E.orders(spark, folder), "order", 1).valid


@query
def conform_orders_v2(spark, folder):
    valid = C.conform(E.orders(spark, folder), "order", 2).valid
    return _doubles(valid, "subtotal", "tax_amount", "shipping_amount", "discount_amount", "total_amount")


@query
def conform_rejects(spark, folder):
    rejected = C.conform(E.orders(spark, folder), "order", 2).rejected
    return rejected.select("id", "status", F.array_join(C.REASONS, "; ").alias("reasons"))


def _damaged(df, token):
    """Rows with NULL keys, unreadable numbers and unknown words here and there, by their ids."""
    every = lambda n: F.col("id") % n == 0
    out = df.withColumn("user_token", F.when(~every(17), token)).withColumn("status", F.when(every(13), "lost").otherwise(F.col("status")))
    if "amount" in df.columns:
        out = out.withColumn("amount", F.when(every(11), "12,5o").otherwise(F.col("amount").cast("string")))
    else:
        out = out.withColumn("retry_count", F.when(every(11), "often").otherwise(F.col("retry_count").cast("string")))
        out = out.withColumn("channel", F.when(every(7), "pigeon").when(every(19), F.lit(None)).otherwise(F.col("channel")))
    return out


@query
def conform_rejects_payments(spark, folder):
    rows = _damaged(E.payments(spark, folder), S.user_token(F.col("user_id"), SALT))
    return C.conform(rows, "payment", 2).rejected.select("id", F.array_join(C.REASONS, "; ").alias("reasons"))


@query
def conform_rejects_notifications(spark, folder):
    rows = _damaged(E.notifications(spark, folder), S.user_token(F.col("user_id"), SALT))
    return C.conform(rows, "notification", 2).rejected.select("id", F.array_join(C.REASONS, "; ").alias("reasons"))


@query
def conform_order_items_v1(spark, folder):
    return C.conform(E.order_items(spark, folder), "order_item", 1).valid.select(
        "id", "order_id", "product_id", "product_name", "quantity", "unit_price", "total_price"
    )


@query
def conform_order_items_v2(spark, folder):
    valid = C.conform(E.order_items(spark, folder), "order_item", 2).valid
    return _doubles(valid, "unit_price", "discount_amount", "tax_amount", "total_price").select(
        "id", "order_id", "product_id", "quantity", "unit_price", "discount_amount", "tax_amount", "total_price",
        "product_name", "is_gift",
    )


@query
def conform_payments_v1(spark, folder):
    return C.conform(E.payments(spark, folder), "payment", 1).valid.select(
        "id", "order_id", "user_id", "amount", "currency", "status", "payment_method", "created_at",
        "card_number", "cardholder_name", "billing_address",
    )


@query
def conform_payments_v2(spark, folder):
    valid = C.conform(PR.tokenize_payments(E.payments(spark, folder), SALT), "payment", 2).valid
    return _doubles(valid, "amount").select(
        "id", "order_id", "user_id", "amount", "currency", "status", "payment_method", "card_token",
        "card_last_four", "cardholder_token", "created_at", "processing_time_ms",
    )


@query
def conform_refunds_v1(spark, folder):
    return C.conform(E.refunds(spark, folder), "refund", 1).valid.select(
        "id", "payment_id", "order_id", "amount", "status", "created_at"
    )


@query
def conform_refunds_v2(spark, folder):
    valid = C.conform(E.refunds(spark, folder), "refund", 2).valid
    return _doubles(valid, "amount").select(
        "id", "payment_id", "order_id", "amount", "currency", "status", "created_at"
    )


@query
def conform_notifications_v1(spark, folder):
    return C.conform(E.notifications(spark, folder), "notification", 1).valid.select(
        "id", "user_id", "channel", "notification_type", "status", "created_at", "sent_at", "delivered_at",
        "opened_at", "clicked_at", "failed_at",
    )


@query
def conform_notifications_v2(spark, folder):
    return C.conform(E.notifications(spark, folder), "notification", 2).valid.select(
        "id", "user_id", "user_token", "channel", "notification_type", "status", "sent_at", "delivered_at",
        "opened_at", "clicked_at", "failed_at", "retry_count", "max_retries",
    )


@query
def publish_users_v1(spark, folder):
    return C.publish(C.conform(E.users(spark, folder), "user", 1).valid, "user", 1, SALT)


@query
def publish_orders(spark, folder):
    return C.publish(C.conform(E.orders(spark, folder), "order", 2).valid, "order", 2).select(
        "id", "user_id", "order_number", "subtotal", "total_amount", "currency", "status", "item_count", "created_at"
    )


@query
def publish_payments(spark, folder):
    safe = PR.tokenize_payments(E.payments(spark, folder), SALT)
    return C.publish(C.conform(safe, "payment", 2).valid, "payment", 2).select(
        "id", "order_id", "amount", "currency", "status", "payment_method", "card_token", "card_last_four"
    )


@query
def flatten_struct(spark, folder):
    nested = parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("place"),
        ).alias("profile"),
        F.struct(F.col("c_acctbal").alias("balance")).alias("account"),
    )
    return C.flatten(nested)


@query
def safe_projection(spark, folder):
    return PR.keep_safe(E.users(spark, folder))


@query
def required_fields_check(spark, folder):
    return C.completeness_report(
        E.payments(spark, folder), ["id", "amount", "card_number", "cardholder_name", "created_at"]
    )


# --- state flags and row checks ------------------------------------------------------------


@query
def user_state_flags(spark, folder):
    return U.user_flags(E.users(spark, folder)).select("id", "is_verified", "is_premium")


@query
def order_state_flags(spark, folder):
    return O.order_flags(E.orders(spark, folder)).select("id", "status", "is_completed", "is_active")


@query
def payment_state_flags(spark, folder):
    flagged = P.payment_flags(E.payments(spark, folder))
    return flagged.groupBy("merchant_id", "status", "is_successful", "is_refundable").agg(F.count("*").alias("rows"))


@query
def notification_state_flags(spark, folder):
    return N.notification_flags(E.notifications(spark, folder)).select(
        "id", "status", "is_delivered", "is_engaged", "can_retry"
    )


@query
def notification_state_flags_v1(spark, folder):
    return N.notification_flags_v1(E.notifications(spark, folder)).select(
        "id", "is_delivered", "is_opened", "is_clicked"
    )


@query
def retry_queue(spark, folder):
    return N.retry_queue(E.notifications(spark, folder)).select("id", "user_id", "channel", "retry_count")


@query
def delivery_latency(spark, folder):
    latency = N.delivery_latency(E.notifications(spark, folder)).select("id", "delivery_time_ms")
    return _doubles(latency, "delivery_time_ms")


@query
def email_validity(spark, folder):
    return E.address_candidates(spark, folder).select("id", "email", is_email(F.col("email")).alias("is_valid"))


@query
def report_format(spark, folder):
    orders = E.orders(spark, folder)
    currency = (
        F.when(F.col("status") == "pending", "EUR").when(F.col("status") == "shipped", "GBP")
        .when(F.col("status") == "cancelled", "JPY").otherwise("USD")
    )
    return orders.select(
        "id",
        currency_text(F.col("total_amount"), currency).alias("amount_text"),
        shorten(F.col("order_number"), 12).alias("short_number"),
        divide_or(F.col("user_id"), F.col("id")).alias("ratio"),
    )


@query
def text_preview(spark, folder):
    return parquet_table(spark, folder, "documents").select("doc_id", shorten(F.col("text")).alias("preview"))


# --- users ---------------------------------------------------------------------------------


@query
def registration_daily(spark, folder):
    return U.registrations(E.users(spark, folder), EVER)


@query
def registration_daily_inline(spark, folder):
    return U.registrations(E.users(spark, folder), EVER, with_enterprise=False)


@query
def registration_daily_v1(spark, folder):
    return U.registrations_v1(E.users(spark, folder), EVER)


@query
def user_activity(spark, folder):
    active = U.user_activity(E.users(spark, folder), E.activity(spark, folder), SINCE)
    return active.withColumn("activity_types", F.array_join("activity_types", ","))


@query
def user_activity_v1(spark, folder):
    return U.user_activity_v1(E.users(spark, folder), E.activity(spark, folder), SINCE, SALT)


@query
def churn_by_status(spark, folder):
    return U.churn(E.users(spark, folder), STATUSES, SINCE)


@query
def churn_by_status_v1(spark, folder):
    return U.churn_v1(E.users(spark, folder), SINCE)


@query
def user_segments(spark, folder):
    totals = U.order_totals(E.orders(spark, folder))
    return _doubles(U.segments(E.users(spark, folder), totals, SINCE), "segment_revenue")


@query
def user_segments_of_few_buyers(spark, folder):
    """Orders are the purchases of the first half hours, which only some of the users make: all four segments occur."""
    bought = parquet_table(spark, folder, "events").filter("event_type = 'purchase' AND minute(ts) < 30")
    bought = bought.select(F.col("event_id").alias("id"), "user_id", F.floor("value").cast("decimal(18,2)").alias("total_amount"))
    return _doubles(U.segments(E.users(spark, folder), U.order_totals(bought), SINCE), "segment_revenue")


@query
def user_segments_detail(spark, folder):
    members = U.segment_members(E.users(spark, folder), E.orders(spark, folder), SINCE, SALT)
    return _doubles(members, "total_spend")


def _hashed_documents(spark, folder):
    return parquet_table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.sha2("text", 256).alias("identity_hash")
    )


@query
def duplicate_identities(spark, folder):
    return U.duplicate_identities(_hashed_documents(spark, folder))


@query
def duplicate_identities_v1(spark, folder):
    return U.duplicate_identities_v1(E.contacts(spark, folder))


@query
def cohort_retention(spark, folder):
    return U.retention(E.users(spark, folder), E.order_activity(spark, folder), SINCE)


@query
def cohort_activity(spark, folder):
    return U.cohort_activity(E.users(spark, folder), E.order_activity(spark, folder), SINCE)


@query
def daily_active_users(spark, folder):
    return U.daily_active_users(E.users(spark, folder), E.activity(spark, folder), EVER)


def _actives(spark, folder, period):
    """Activity in two parts, the second late and taken in twice."""
    path, rows, late = shared_folder(spark, "actives"), E.activity(spark, folder), F.xxhash64("id") < 0
    for part in (rows.where(~late), rows.where(late), rows.where(late)):
        A.merge_actives(E.users(spark, folder), part, path)
    return A.actives(spark.read.parquet(path), period)


@query
def daily_actives_of_bitmaps(spark, folder):
    return _actives(spark, folder, "day")


@query
def weekly_actives_of_bitmaps(spark, folder):
    return _actives(spark, folder, "week")


@query
def monthly_actives_of_bitmaps(spark, folder):
    return _actives(spark, folder, "month")


BUCKETS = 8


@query
def user_segments_of_buckets(spark, folder):
    """Segments per person over tables that lie by user."""
    users, orders = bucketed(E.users(spark, folder), "id", BUCKETS), bucketed(E.orders(spark, folder), "user_id", BUCKETS)
    return _doubles(U.segment_members(users, orders, SINCE, SALT), "total_spend")


@query
def cohort_retention_of_buckets(spark, folder):
    users, activity = bucketed(E.users(spark, folder), "id", BUCKETS), bucketed(E.order_activity(spark, folder), "user_id", BUCKETS)
    return U.retention(users, activity, SINCE, by_user=True)


@query
def user_metrics_v1(spark, folder):
    return U.user_metrics_v1(U.user_records(E.users(spark, folder), EVER, 1), AS_OF)


@query
def user_metrics_v2(spark, folder):
    return U.user_metrics(U.user_records(E.users(spark, folder), EVER), AS_OF)


# --- orders, payments, notifications -------------------------------------------------------


@query
def order_daily(spark, folder):
    return _doubles(O.daily_orders(E.orders(spark, folder), EVER), "total_revenue", "avg_order_value")


@query
def order_metrics_v2(spark, folder):
    return O.order_metrics(O.daily_orders(E.orders(spark, folder), EVER))


@query
def order_metrics_v1(spark, folder):
    return O.order_metrics_v1(O.daily_orders(E.orders(spark, folder), EVER))


@query
def payment_daily(spark, folder):
    return _doubles(P.daily_payments(E.payments(spark, folder), EVER), "total_amount")


@query
def payment_metrics(spark, folder):
    safe = P.protect_payments(E.payments(spark, folder), "token", SALT)
    return P.payment_metrics(P.daily_payments(safe, EVER))


def _repeated(daily):
    """Extracted rows with some of them twice, as a broken extract may give them; the transform removes the copies."""
    return daily.unionByName(daily.filter(F.dayofmonth(daily.columns[0]) <= 10))


@query
def order_metrics_of_repeats(spark, folder):
    return O.order_metrics(_repeated(O.daily_orders(E.orders(spark, folder), EVER, ordered=False)))


@query
def payment_metrics_of_repeats(spark, folder):
    return P.payment_metrics(_repeated(P.daily_payments(E.payments(spark, folder), EVER, ordered=False)))


@query
def notification_metrics_of_repeats(spark, folder):
    return N.notification_metrics(_repeated(N.daily_notifications(E.notifications(spark, folder), EVER, ordered=False)))


@query
def notification_daily(spark, folder):
    return N.daily_notifications(E.notifications(spark, folder), EVER)


@query
def notification_metrics(spark, folder):
    return N.notification_metrics(N.daily_notifications(E.notifications(spark, folder), EVER))


@query
def notification_metrics_v1(spark, folder):
    return N.notification_metrics(N.daily_notifications(E.notifications(spark, folder), EVER), version=1)


@query
def channel_metrics(spark, folder):
    return N.channel_metrics(notification_metrics(spark, folder))


# --- privacy -------------------------------------------------------------------------------


@query
def tokenize_column(spark, folder):
    cards = E.contacts(spark, folder).select("id", "n", "card_number")
    return PR.tokenize_columns(cards, {"card_number": S.CARD}, SALT)


@query
def tokenize_contacts(spark, folder):
    return PR.tokenize_contacts(E.users(spark, folder).select("id", "email", "phone", "name"), SALT)


@query
def tokenize_payments(spark, folder):
    columns = ("id", "amount", "card_number", "cardholder_name", "billing_address")
    return _doubles(PR.tokenize_payments(E.payments(spark, folder).select(*columns), SALT), "amount")


@query
def payment_pii_stage(spark, folder):
    """What the payment pipeline makes of card numbers in either mode, counted by method after it."""
    payments = E.payments(spark, folder)
    token = P.protect_payments(payments, "token", SALT).select(F.lit("token").alias("mode"), "payment_method", F.col("card_token").alias("card"))
    mask = P.protect_payments(payments, "mask").select(F.lit("mask").alias("mode"), "payment_method", F.col("card_display").alias("card"))
    return token.union(mask).groupBy("mode", "payment_method").agg(
        F.count("*").alias("payments"), F.count_distinct("card").alias("cards"), F.sum(F.conv(F.substring(F.md5("card"), 1, 6), 16, 10).cast("long")).alias("print"))


@query
def mask_payments(spark, folder):
    columns = ("id", "card_number", "cardholder_name", "billing_address")
    return PR.mask_payments(E.payments(spark, folder).select(*columns))


@query
def redact_table(spark, folder):
    return PR.redact(E.contacts(spark, folder))


@query
def redact_table_v1(spark, folder):
    return PR.redact_all(E.contacts(spark, folder))


@query
def salted_hash(spark, folder):
    return E.users(spark, folder).select("id", S.salted_sha256(F.col("email"), SALT).alias("email_hash"))


@query
def mask_contacts(spark, folder):
    return PR.mask_contacts(E.contacts(spark, folder))


@query
def hash_contacts(spark, folder):
    return PR.hash_columns(E.contacts(spark, folder).select("id", "n", "email", "phone"), ["email", "phone"])


@query
def anonymize_users(spark, folder):
    return PR.anonymize_users(E.users(spark, folder).select("id", "email", "phone", "name", "status"))


@query
def contact_features(spark, folder):
    return PR.contact_features(E.contacts(spark, folder), ("id", "n"))


@query
def sanitize_nested(spark, folder):
    users = E.users(spark, folder)
    nested = users.select(
        "id",
        F.struct("email", "status", F.struct("phone", "country_code").alias("reach")).alias("profile"),
        F.col("user_token"),
    )
    return C.flatten(PR.sanitize(nested))


# --- fingerprints and duplicates -----------------------------------------------------------


@query
def record_fingerprint(spark, folder):
    documents = parquet_table(spark, folder, "documents")
    return documents.select("doc_id", FP.record_fingerprint(documents).alias("fingerprint"))


@query
def field_fingerprint(spark, folder):
    orders = parquet_table(spark, folder, "orders")
    fields = ["o_orderstatus", "o_custkey", "o_orderpriority", "o_comment"]
    return orders.select(
        "o_orderkey",
        FP.field_fingerprint(orders, fields).alias("sha256"),
        FP.field_fingerprint(orders, fields, "md5").alias("md5"),
    )


@query
def identity_hash(spark, folder):
    contact = [F.col(c) for c in ("email", "phone", "name")]
    return E.users(spark, folder).select(
        "id", FP.identity_hash(*contact).alias("sha256"), FP.identity_hash(*contact, "md5").alias("md5")
    )


def _text_print():
    return F.sha2("text", 256)


def _labelled(spark, folder, **equals):
    """Fingerprints of the documents that have a label, as the batch that came before. Only digests are joined."""
    labels = select_where(parquet_table(spark, folder, "labels"), ["doc_id"], equals)
    prints = parquet_table(spark, folder, "documents").select("doc_id", _text_print().alias(D.FINGERPRINT))
    return prints.join(labels, "doc_id", "left_semi")


@query
def known_duplicates(spark, folder):
    seen = D.fingerprint_table(_labelled(spark, folder), F.col(D.FINGERPRINT))
    prints = D.pairs(parquet_table(spark, folder, "documents"), _text_print(), "doc_id")
    return D.known_records(prints, F.col(D.FINGERPRINT), seen)


@query
def mark_new(spark, folder):
    seen = D.fingerprint_table(_labelled(spark, folder, quality=0), F.col(D.FINGERPRINT))
    documents = parquet_table(spark, folder, "documents").select("doc_id", "text")
    return D.mark_new(documents, _text_print(), "doc_id", seen)


@query
def dedup_records(spark, folder):
    documents = parquet_table(spark, folder, "documents")
    return D.first_per_fingerprint(documents, _text_print(), "doc_id").drop("text")


@query
def dedup_new_records(spark, folder):
    seen = D.fingerprint_table(_labelled(spark, folder, quality=1), F.col(D.FINGERPRINT))
    documents = parquet_table(spark, folder, "documents")
    return D.new_records(documents, _text_print(), "doc_id", seen).drop("text")


@query
def dedup_batches(spark, folder):
    """Labelled documents come first, then all; new ones of the second batch, with the fingerprints stored between."""
    path = shared_folder(spark, "seen")
    D.remember(_labelled(spark, folder), F.col(D.FINGERPRINT), path)
    documents = parquet_table(spark, folder, "documents").select("doc_id", "text")
    return D.new_records(documents, _text_print(), "doc_id", D.recall(spark, path)).select("doc_id", D.FINGERPRINT)


def _stored_prints(spark, folder):
    """A store with the labelled documents, in two batches that share many of them."""
    store = K.Store(shared_folder(spark, "known"))
    K.remember(_labelled(spark, folder), store, 0)
    K.remember(_labelled(spark, folder, quality=1), store, 1)
    return store


@query
def dedup_known_store(spark, folder):
    """As ``dedup_batches``, with the fingerprints in the store that is read in part."""
    store = _stored_prints(spark, folder)
    documents = parquet_table(spark, folder, "documents").select("doc_id", "text")
    seen = K.known(D.fingerprint_table(documents, _text_print()), store)
    return D.new_records(documents, _text_print(), "doc_id", seen).select("doc_id", D.FINGERPRINT)


@query
def known_store_lookup(spark, folder):
    """The documents whose fingerprints the store holds, as ``known_duplicates``."""
    store = _stored_prints(spark, folder)
    prints = D.pairs(parquet_table(spark, folder, "documents"), _text_print(), "doc_id")
    return D.known_records(prints, F.col(D.FINGERPRINT), K.known(prints, store))


@query
def dedup_repeated_batch(spark, folder):
    events = parquet_table(spark, folder, "events")
    return D.distinct_records(events.unionByName(events))


# --- windows, loading, jobs ----------------------------------------------------------------


@query
def previous_day_slice(spark, folder):
    events = parquet_table(spark, folder, "events")
    return events.filter(day_before(datetime(2024, 1, 15, 10, 30)).holds(F.col("ts")))


@query
def previous_hour_slice(spark, folder):
    events = parquet_table(spark, folder, "events")
    return events.filter(hour_before(datetime(2024, 1, 15, 10, 30)).holds(F.col("ts")))


@query
def backfill_chunks(spark, folder):
    span = Span(datetime(1994, 12, 30), datetime(2001, 6, 15, 18))
    return J.backfill_chunks(E.orders(spark, folder), "created_at", span, 7)


@query
def append_if_absent_rows(spark, folder):
    """One status is loaded first, then everything twice: every key is there once."""
    path = shared_folder(spark, "append")
    key = ["order_date", "status"]
    everything = O.order_metrics(O.daily_orders(E.orders(spark, folder), EVER))
    append_if_absent(everything.filter(F.col("status") == "pending"), path, key)
    append_if_absent(everything, path, key)
    append_if_absent(everything, path, key)
    return spark.read.parquet(path)


def _jobs(spark, folder):
    sources = {
        "users": E.users(spark, folder), "orders": E.orders(spark, folder), "payments": E.payments(spark, folder),
        "notifications": E.notifications(spark, folder),
    }
    return J.all_jobs(sources, EVER, AS_OF, SALT)


def _loaded(spark, folder, job, table):
    warehouse = shared_folder(spark, "warehouse")
    J.run_job(_jobs(spark, folder)[job](), warehouse)
    return spark.read.parquet(f"{warehouse}/{table}")


@query
def load_user_analytics(spark, folder):
    return _loaded(spark, folder, "user_analytics", "user_analytics")


@query
def load_order_analytics(spark, folder):
    return _loaded(spark, folder, "order_analytics", "order_analytics")


@query
def load_payment_analytics(spark, folder):
    return _loaded(spark, folder, "payment_analytics", "payment_analytics")


@query
def load_notification_analytics(spark, folder):
    return _loaded(spark, folder, "notification_analytics", "notification_analytics")


@query
def load_channel_analytics(spark, folder):
    return _loaded(spark, folder, "notification_analytics", "channel_analytics")


@query
def run_summary(spark, folder):
    jobs = _jobs(spark, folder) | {
        "refund_analytics": lambda: J.order_job(parquet_table(spark, folder, "refunds"), EVER)  # there is no such table
    }
    done = J.run_jobs(jobs, shared_folder(spark, "unused"), dry_run=True)
    return J.summary_frame(spark, done).select(
        "job_name", "status", "records_extracted", "records_transformed", "records_loaded", "records_processed", "records_skipped",
        "records_failed", "window_start", "window_end", "error_count"
    )


@query
def backfill_load(spark, folder):
    """A quarter loaded week by week, one week twice, and one piece that has no source at first."""
    span, orders = Span(datetime(1996, 1, 1), datetime(1996, 3, 27)), E.orders(spark, folder)
    warehouse, missing = shared_folder(spark, "warehouse"), [datetime(1996, 2, 5)]

    def make(piece):
        if piece.start in missing:
            raise ValueError("no source")
        return J.order_job(orders, piece)

    J.run_backfill(make, span, warehouse, name="order_analytics")
    missing.clear()
    J.run_backfill(make, span, warehouse, name="order_analytics")
    return spark.read.parquet(f"{warehouse}/order_analytics")


@query
def backfill_one_scan(spark, folder):
    """All weeks of the orders in one pass."""
    warehouse = shared_folder(spark, "warehouse")
    B.backfill_at_once(lambda s: J.order_job(E.orders(spark, folder), s), EVER, warehouse)
    return spark.read.parquet(f"{warehouse}/order_analytics")


@query
def backfill_users_one_scan(spark, folder):
    warehouse = shared_folder(spark, "warehouse")
    B.backfill_at_once(lambda s: J.user_job(E.users(spark, folder), s, AS_OF), EVER, warehouse, days=30)
    return spark.read.parquet(f"{warehouse}/user_analytics")


@query
def backfill_channel_windows(spark, folder):
    """The channel rollups of all weeks, each with its window."""
    warehouse = shared_folder(spark, "warehouse")
    B.backfill_at_once(lambda s: J.notification_job(E.notifications(spark, folder), s), EVER, warehouse)
    return spark.read.parquet(f"{warehouse}/channel_analytics")


@query
def backfill_outcomes(spark, folder):
    """The outcome of every four weeks of payments, one of which cannot be loaded."""

    def make(span):
        if span.covers(datetime(1996, 2, 5)):
            raise ValueError("no source")
        return J.payment_job(E.payments(spark, folder), span, salt=SALT)

    done = B.backfill_at_once(make, EVER, shared_folder(spark, "warehouse"), days=28, name="payment_analytics")
    return J.summary_frame(spark, done).select(
        "job_name", "status", "records_extracted", "records_loaded", "records_skipped", "records_failed", "window_start", "window_end", "error_count")


def _merged(spark, folder, increment, rows):
    """All rows in two batches, of which the second comes late and is taken in twice."""
    warehouse, late = shared_folder(spark, "warehouse"), F.xxhash64("id") < 0
    for batch, part in ((0, rows.where(~late)), (1, rows.where(late)), (1, rows.where(late))):
        I.merge_rows(increment, part, warehouse, batch)
    return spark.read.parquet(f"{warehouse}/{increment.table}").drop(I.MONTH)


@query
def merged_order_analytics(spark, folder):
    return _merged(spark, folder, I.ORDERS, E.orders(spark, folder))


@query
def merged_payment_analytics(spark, folder):
    return _merged(spark, folder, I.PAYMENTS, E.payments(spark, folder))


@query
def merged_notification_analytics(spark, folder):
    return _merged(spark, folder, I.NOTIFICATIONS, E.notifications(spark, folder))


@query
def merged_user_analytics(spark, folder):
    warehouse, users, late = shared_folder(spark, "warehouse"), E.users(spark, folder), F.xxhash64("id") < 0
    for part in (users.where(~late), users.where(late), users.where(late)):
        I.merge_users(part, warehouse, AS_OF)
    return spark.read.parquet(f"{warehouse}/user_analytics").drop(I.MONTH)


@query
def load_differences(spark, folder):
    """A table without some late orders against all of them, but for cancelled ones of one month."""
    orders, at = E.orders(spark, folder), F.col("created_at")
    late = Span(datetime(1996, 2, 1), datetime(1996, 3, 1)).holds(at) & (F.col("total_amount") < 100_000)
    late = late | Span(datetime(1996, 5, 10), datetime(1996, 5, 11)).holds(at)
    taken_back = Span(datetime(1997, 7, 1), datetime(1997, 8, 1)).holds(at) & (F.col("status") == "cancelled")

    def ranged(rows):
        day = F.col("order_date")
        return O.order_metrics(O.daily_orders(rows, EVER, ordered=False)).withColumns({"year": F.year(day), "month": F.trunc(day, "MM")})

    path, ranges = f"{shared_folder(spark, 'warehouse')}/order_analytics", ("year", "month")
    loaded = ranged(orders.where(~late))
    replace_partitions(loaded, path, "month")
    PF.store_digests(loaded, path, ranges, "month")
    return PF.load_differences(
        ranged(orders.where(~taken_back)), spark.read.parquet(path), spark.read.parquet(f"{path}_digests"), ("order_date", "status"), ranges, "month")


def _records(spark, folder):
    """Events as JSON records with keys that differ from row to row, lists in lists, and names that are personal data."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    record = F.concat(
        F.lit('{"kind": "'), kind, F.lit('", "'), kind, F.lit('_token": "'), user, F.lit('", "at": {"user_Email": "u'), user,
        F.lit('@shop.test", "'), kind, F.lit('": [[{"phone": "1", "k": '), user, F.lit('}], "'), kind, F.lit('"]}, "props": '), "props", F.lit("}"))
    return R.spread(parquet_table(spark, folder, "events").select("event_id", "event_type", "user_id", "props"), "event_id").select(
        "event_id", record.alias("record"))


@query
def sanitize_records(spark, folder):
    return R.sanitize_json(_records(spark, folder), "record")


@query
def flatten_records(spark, folder):
    return R.flatten_json(_records(spark, folder), "record")


def _props(spark, folder):
    """Events with their properties as a map, and in an array of structs, with names that are personal data."""
    words = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user_email"), F.concat(F.col("user_id").cast("string"), F.lit("@shop.test")))
    parts = F.array(F.struct(F.col("event_type").alias("step"), F.col("user_id").cast("string").alias("phone")))
    return parquet_table(spark, folder, "events").select("event_id", words.alias("words"), parts.alias("parts"))


@query
def sanitize_maps(spark, folder):
    clean = PR.sanitize(_props(spark, folder))
    return clean.select("event_id", F.col("words")["kind"].alias("kind"), F.col("words")["user_email"].alias("user_email"),
                        F.col("parts")[0]["step"].alias("step"), F.col("parts")[0]["phone"].alias("phone"))


@query
def record_fingerprint_nested(spark, folder):
    """Events whose fingerprint stays the same when map entries and struct fields come in another order."""
    props = _props(spark, folder)
    other = props.select(
        "event_id", F.map_from_entries(F.reverse(F.map_entries("words"))).alias("words"),
        F.transform("parts", lambda p: F.struct(p["phone"].alias("phone"), p["step"].alias("step"))).alias("parts"))
    one, two = (d.select("event_id", FP.record_fingerprint(d, columns=["words", "parts"]).alias(n)) for d, n in ((props, "one"), (other, "two")))
    return one.join(two, "event_id").select("event_id", (F.col("one") == F.col("two")).alias("same"), F.length("one").cast("long").alias("digits"))


# --- streams -------------------------------------------------------------------------------


def _streamed(spark, stream):
    out = shared_folder(spark, "stream")
    ST.run_available(ST.sink_parquet(stream, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table")


@query
def stream_dedup(spark, folder):
    events = ST.parquet_stream(spark, folder, "events")
    kind = F.sha2(F.concat_ws("|", "user_id", "event_type"), 256)
    out = shared_folder(spark, "stream")
    ST.run_available(ST.sink_new_records(events, kind, "event_id", f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table").select("event_id", D.FINGERPRINT, "user_id", "event_type")


@query
def stream_dedup_within_delay(spark, folder):
    """The variant with bounded state; here no event is later than the delay."""
    events = ST.parquet_stream(spark, folder, "events")
    kind = F.sha2(F.concat_ws("|", "user_id", "event_type"), 256)
    return _streamed(spark, ST.dedup_stream(events, kind, "ts", "60 days")).select(D.FINGERPRINT, "user_id", "event_type")


@query
def stream_append(spark, folder):
    out = shared_folder(spark, "stream")
    events = ST.parquet_stream(spark, folder, "events").withColumn("day", F.to_date("ts"))
    for attempt in ("first", "again"):
        # The second run sees the same events as new input and must add nothing.
        ST.run_available(
            ST.sink_if_absent(events, f"{out}/table", ["day", "user_id", "event_type"], f"{out}/{attempt}", "day")
        )
    return spark.read.parquet(f"{out}/table").select("day", "user_id", "event_type")


def _all_windows(spark, windows, keys):
    out = shared_folder(spark, "stream")
    ST.run_available(ST.sink_windows(windows, f"{out}/table", f"{out}/checkpoint"))
    return _plain_times(ST.latest_windows(spark, f"{out}/table", keys))


def _plain_times(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query
def stream_notification_windows(spark, folder):
    stream = E.notification_columns(ST.parquet_stream(spark, folder, "events"))
    return _all_windows(spark, ST.notification_windows(stream), ["channel", "notification_type"])


@query
def stream_order_windows(spark, folder):
    stream = E.order_columns(ST.parquet_stream(spark, folder, "orders"))
    windows = ST.order_windows(stream, "1 day", "1 day")
    return _doubles(_all_windows(spark, windows, ["status"]), "total_revenue")


@query
def stream_payment_windows(spark, folder):
    stream = E.payment_columns(ST.parquet_stream(spark, folder, "lineitem"))
    windows = ST.payment_windows(stream, "1 day", "1 day")
    return _doubles(_all_windows(spark, windows, ["payment_method"]), "total_amount")


@query
def stream_merged_orders(spark, folder):
    out = shared_folder(spark, "stream")
    stream = E.order_columns(ST.parquet_stream(spark, folder, "orders"))
    ST.run_available(I.sink_merged(stream, I.ORDERS, out, f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/order_analytics").drop(I.MONTH)
