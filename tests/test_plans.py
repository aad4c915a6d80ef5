"""The analytics on small hand-made frames, where the expected values are worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.functions.time import Span
from tallyhouse.plans import notifications as N
from tallyhouse.plans import orders as O
from tallyhouse.plans import payments as P
from tallyhouse.plans import users as U

JUNE = Span(datetime(2024, 6, 1), datetime(2024, 6, 15))
START = datetime(2024, 1, 1)

USERS = [
    (1, "usr_1", "john.doe@example.com", "John Doe", "+1-555-123-4567", datetime(2024, 1, 15, 10, 30), "active",
     "premium", True, datetime(2024, 1, 15, 11), datetime(2024, 6, 1, 9), datetime(2024, 6, 1, 9, 30), "US", "web"),
    (2, "usr_2", "jane.smith@example.com", "Jane Smith", "+44-20-1234-5678", datetime(2024, 2, 20, 14), "active",
     "basic", True, datetime(2024, 2, 20, 15), datetime(2024, 5, 15, 12), datetime(2024, 5, 15, 13), "GB", "mobile"),
    (3, "usr_3", "bob.wilson@example.com", "Bob Wilson", "+1-555-987-6543", datetime(2024, 3, 10, 8), "inactive",
     "enterprise", False, None, datetime(2024, 3, 15, 10), None, "US", "referral"),
]
USER_SCHEMA = (
    "id long, user_token string, email string, name string, phone string, created_at timestamp_ntz, status string, "
    "subscription_tier string, email_verified boolean, email_verified_at timestamp_ntz, last_login_at timestamp_ntz, "
    "last_activity_at timestamp_ntz, country_code string, signup_source string"
)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(USERS, USER_SCHEMA)


@pytest.fixture(scope="module")
def activity(spark):
    rows = [
        (1, 1, "login", datetime(2024, 6, 1, 8)), (2, 1, "login", datetime(2024, 6, 1, 9)),
        (3, 1, "search", datetime(2024, 6, 2)), (4, 3, "login", datetime(2024, 6, 2)),
        (5, 99, "login", datetime(2024, 6, 2)), (6, 3, "login", datetime(2023, 12, 31)),
    ]
    return spark.createDataFrame(rows, "id long, user_id long, activity_type string, created_at timestamp_ntz")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_user_metrics(users):
    got = U.user_metrics(users.union(users), datetime(2024, 6, 15))
    assert sorted(rows(got)) == [
        ("usr_1", USERS[0][5], "active", "premium", True, 13, "US", "web"),
        ("usr_2", USERS[1][5], "active", "basic", True, 30, "GB", "mobile"),
        ("usr_3", USERS[2][5], "inactive", "enterprise", False, None, "US", "referral"),
    ]


def test_user_metrics_v1(users):
    old = users.withColumnRenamed("subscription_tier", "subscription_type")
    got = sorted(rows(U.user_metrics_v1(old, datetime(2024, 6, 1, 8, 59))))
    assert [(r[0], r[4], r[5]) for r in got] == [(1, True, -1), (2, True, 16), (3, False, 77)]


def test_user_activity(users, activity):
    got = U.user_activity(users, activity, START)
    assert sorted(rows(got)) == [
        (1, "usr_1", 3, datetime(2024, 6, 2), ["login", "search"]),
        (3, "usr_3", 2, datetime(2024, 6, 2), ["login"]),
    ]
    assert [r.user_id for r in U.user_activity(users, activity, datetime(2024, 3, 1)).collect()] == [3]


def test_people_with_the_same_contact_are_one_in_v1(spark, users, activity):
    twin = spark.createDataFrame([(99, *USERS[0][1:])], USER_SCHEMA)
    got = U.user_activity_v1(users.union(twin), activity, START, "s").collect()
    assert sorted(r.activity_count for r in got) == [2, 4]
    assert all(r.email_token.startswith("eml_") and r.name_token.startswith("nam_") for r in got)


def test_daily_active_users(users, activity):
    assert rows(U.daily_active_users(users, activity, JUNE)) == [
        (date(2024, 6, 1), 1, 1, 0), (date(2024, 6, 2), 2, 1, 1)
    ]


def test_repeated_user_rows_do_not_change_daily_actives(users, activity):
    assert rows(U.daily_active_users(users.union(users), activity, JUNE)) == rows(
        U.daily_active_users(users, activity, JUNE)
    )


def test_churn(spark):
    at = datetime(2024, 1, 1)
    days = [None, 0, 1, 5, 10]
    data = [("active", at, None if d is None else datetime(2024, 1, 1 + d, 23)) for d in days] + [("lost", at, None)]
    df = spark.createDataFrame(data, "status string, created_at timestamp_ntz, last_activity_at timestamp_ntz")
    assert sorted(rows(U.churn(df, ["active", "lost"], at))) == [("active", 5, 4.0, 3.0), ("lost", 1, None, None)]
    assert rows(U.churn(df, ["active"], datetime(2025, 1, 1))) == []


def test_churn_v1_counts_midnights(spark):
    data = [("active", datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 1)), ("dormant", datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(data, "status string, created_at timestamp_ntz, last_login_at timestamp_ntz")
    assert sorted(rows(U.churn_v1(df, START))) == [("active", 1, 1.0), ("dormant", 1, None)]


def test_segments_include_users_without_orders(spark, users):
    orders = spark.createDataFrame([(i, 1, 10.0) for i in range(10)] + [(i, 2, 0.5) for i in range(5)], "id long, user_id long, total_amount double")
    got = sorted(rows(U.segments(users, U.order_totals(orders), START)))
    assert got == [
        ("high_value", 1, 10.0, 100.0, Decimal("100.00")), ("medium_value", 1, 5.0, 2.5, Decimal("2.50")),
        ("no_orders", 1, 0.0, 0.0, Decimal("0.00")),
    ]
    members = {r.total_orders: (r.segment, r.total_spend) for r in U.segment_members(users, orders, START, "s").collect()}
    assert members == {
        10: ("high_value", Decimal("100.00")), 5: ("medium_value", Decimal("2.50")), 0: ("low_value", None)
    }


def test_retention_counts_activity_before_the_cohort(spark, users):
    moments = [(1, 2, datetime(2024, 1, 5)), (2, 2, datetime(2024, 2, 5)), (3, 2, datetime(2024, 2, 6)), (4, 1, datetime(2023, 1, 1))]
    df = spark.createDataFrame(moments, "id long, user_id long, created_at timestamp_ntz")
    feb, jan = date(2024, 2, 1), date(2024, 1, 1)
    assert rows(U.retention(users, df, START)) == [(feb, jan, 1, 100.0), (feb, feb, 1, 100.0)]
    # Only registration is limited here, so the activity of 2023 counts.
    assert rows(U.cohort_activity(users, df, START)) == [(jan, date(2023, 1, 1), 1), (feb, jan, 1), (feb, feb, 1)]


def test_retention_shares(spark):
    users = spark.createDataFrame([(i, datetime(2024, 1, 2)) for i in range(4)], "id long, created_at timestamp_ntz")
    activity = spark.createDataFrame([(i, i % 3, datetime(2024, 2, 2)) for i in range(9)], "id long, user_id long, created_at timestamp_ntz")
    assert rows(U.retention(users, activity, START)) == [(date(2024, 1, 1), date(2024, 2, 1), 3, 75.0)]


def test_order_metrics(spark):
    data = [
        (datetime(2024, 6, 1), "completed", 150, "45000.00", "300.00"), (datetime(2024, 6, 2), "completed", 175, "52500.00", "300.00"),
        (datetime(2024, 6, 2), "completed", 175, "52500.00", "300.00"), (datetime(2024, 6, 3), "pending", 1, None, "1"),
        (datetime(2024, 6, 4), "pending", None, "oops", "1"), (datetime(2024, 6, 5), "pending", None, "2", "1"),
    ]
    df = spark.createDataFrame(data, "order_date timestamp_ntz, status string, order_count long, total_revenue string, avg_order_value string")
    assert sorted(rows(O.order_metrics(df)))[:2] == [data[0], data[1]]
    assert sorted(r[2:] for r in rows(O.order_metrics(df)))[0] == (0, "2", "1")
    assert O.order_metrics(df).count() == 3
    assert sorted(r[3] for r in rows(O.order_metrics_v1(df))) == [2.0, 45000.0, 52500.0]
    bare = df.select("order_date", "status").limit(1)
    assert rows(O.order_metrics(bare))[0][2:] == (0, "0", "0")
    assert rows(O.order_metrics_v1(bare))[0][2:] == (0, 0.0, 0.0)


def test_daily_orders_take_the_default_statuses(spark):
    data = [(i, s, 10.10, datetime(2024, 6, 1, i)) for i, s in enumerate(["completed", "pending", "cancelled", "shipped", "completed"])]
    df = spark.createDataFrame(data, "id long, status string, total_amount double, created_at timestamp_ntz")
    got = rows(O.daily_orders(df, JUNE))
    assert [(r[1], r[2], str(r[3]), str(r[4])) for r in got] == [
        ("cancelled", 1, "10.10", "10.100000"), ("completed", 2, "20.20", "10.100000"), ("pending", 1, "10.10", "10.100000")
    ]
    assert [r[1] for r in rows(O.daily_orders(df, JUNE, ["shipped"]))] == ["shipped"]


def test_payment_metrics(spark):
    data = [
        (datetime(2024, 6, 1), "credit_card", 500, "50000.00", 485, 15, 250),
        (datetime(2024, 6, 2), "paypal", 200, "18000.00", 195, 5, 180),
    ]
    df = spark.createDataFrame(data, (
        "payment_date timestamp_ntz, payment_method string, transaction_count long, total_amount string, "
        "successful long, failed long, avg_processing_time long"
    ))
    got = {r.payment_method: (r.success_rate, r.total_amount, r.successful_count) for r in P.payment_metrics(df).collect()}
    assert got == {"credit_card": (97.0, "50000.00", 485), "paypal": (97.5, "18000.00", 195)}


def test_payment_protection_modes(spark):
    df = spark.createDataFrame([("4111111111111111", "a", "b", 1)], "card_number string, billing_address string, cardholder_name string, id int")
    assert P.protect_payments(df, "mask").columns == ["id", "card_display"]
    assert "card_token" in P.protect_payments(df, "token", "s").columns
    for mode in ("token", "none"):
        with pytest.raises(ValueError):
            P.protect_payments(df, mode)


NOTES = [
    (date(2024, 6, 1), "email", "marketing", 10000, 9500, 2500, 500, 300, 200),
    (date(2024, 6, 1), "sms", "transactional", 5000, 4800, 4000, 800, 50, 150),
    (date(2024, 6, 1), "push", "alert", 8000, 7200, 3600, 720, 100, 700),
]
NOTE_SCHEMA = (
    "notification_date date, channel string, notification_type string, total_sent long, delivered long, opened long, "
    "clicked long, bounced long, failed long"
)


def test_notification_rates(spark):
    got = N.notification_metrics(spark.createDataFrame(NOTES + NOTES[:1], NOTE_SCHEMA)).collect()
    assert {r.channel: (r.delivery_rate, r.open_rate, r.click_rate, r.click_through_rate, r.bounced) for r in got} == {
        "email": (95.0, 26.32, 20.0, 5.0, 300), "sms": (96.0, 83.33, 20.0, 16.0, 50), "push": (90.0, 50.0, 20.0, 9.0, 100)
    }
    old = N.notification_metrics(spark.createDataFrame(NOTES, NOTE_SCHEMA), version=1)
    assert "bounced" not in old.columns and len(got) == 3


def test_channel_rates_come_from_sums(spark):
    data = NOTES + [
        (date(2024, 6, 2), "email", "marketing", 100, 0, 0, 0, 0, 0), (date(2024, 6, 2), "", "x", 1, 1, 1, 1, 0, 0),
        (date(2024, 6, 2), None, "x", 1, 1, 1, 1, 0, 0),
    ]
    got = {r.channel: r for r in N.channel_metrics(N.notification_metrics(spark.createDataFrame(data, NOTE_SCHEMA))).collect()}
    assert set(got) == {"email", "sms", "push"}
    assert (got["email"].total_sent, got["email"].delivery_rate) == (10100, round(9500 / 10100 * 100, 2))


def test_notification_flags(spark):
    data = [("failed", 2, 3), ("failed", 3, 3), ("clicked", 0, 3), (None, 0, 3)]
    df = spark.createDataFrame(data, "status string, retry_count int, max_retries int")
    got = [(r.is_delivered, r.is_engaged, r.can_retry) for r in N.notification_flags(df).collect()]
    assert got == [(False, False, True), (False, False, False), (True, True, False), (False, False, False)]
    assert N.retry_queue(df).count() == 1


def test_latency(spark):
    data = [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 999)), (datetime(2024, 1, 1), None), (None, None)]
    df = spark.createDataFrame(data, "sent_at timestamp_ntz, delivered_at timestamp_ntz")
    assert [r.delivery_time_ms for r in N.delivery_latency(df).collect()] == [1000, None, None]
