"""The entities in both schema versions.

Version 1 carries raw contact data and double money, version 2 carries tokens, decimal
money and closed value lists. ``publish`` marks the columns that leave the warehouse, in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

LONG, INT, STRING, BOOLEAN = "long", "int", "string", "boolean"
DOUBLE, DECIMAL, TIME = "double", "decimal(18,2)", "timestamp_ntz"

TYPES: dict[str, T.DataType] = {
    LONG: T.LongType(), INT: T.IntegerType(), STRING: T.StringType(), BOOLEAN: T.BooleanType(),
    DOUBLE: T.DoubleType(), DECIMAL: T.DecimalType(18, 2), TIME: T.TimestampNTZType(),
}

# The closed value lists of version 2.
USER_STATUS = ("active", "inactive", "suspended", "churned", "pending_verification")
USER_TIER = ("free", "basic", "premium", "enterprise")
ACTIVITY_TYPE = (
    "login", "logout", "page_view", "search", "product_view", "add_to_cart",
    "checkout_start", "purchase", "review_submit", "profile_update",
)
ORDER_STATUS = ("pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded")
CURRENCY = ("USD", "EUR", "GBP", "CAD", "AUD")
PAYMENT_STATUS = (
    "pending", "authorized", "captured", "success", "failed", "cancelled", "refunded", "partially_refunded",
)
PAYMENT_METHOD = ("card", "bank_transfer", "paypal", "apple_pay", "google_pay", "crypto")
CARD_BRAND = ("visa", "mastercard", "amex", "discover", "unknown")
CHANNEL = ("email", "sms", "push", "in_app", "webhook")
NOTIFICATION_TYPE = (
    "order_confirmation", "order_shipped", "order_delivered", "order_cancelled", "payment_received",
    "payment_failed", "refund_processed", "password_reset", "account_verification", "promotional", "system_alert",
)
NOTIFICATION_STATUS = (
    "pending", "queued", "sent", "delivered", "opened", "clicked", "bounced", "failed", "unsubscribed",
)


@dataclass(frozen=True)
class Field:
    """One column: ``required`` must not be NULL, ``default`` replaces NULL, ``allowed`` closes the values."""

    name: str
    kind: str = STRING
    default: Any = None
    required: bool = False
    allowed: tuple[str, ...] = ()
    publish: bool = True


def key(name: str, kind: str = LONG, **more: Any) -> Field:
    return Field(name, kind, required=True, **more)


def hidden(name: str, kind: str = STRING, **more: Any) -> Field:
    return Field(name, kind, publish=False, **more)


def times(*names: str) -> tuple[Field, ...]:
    return tuple(Field(name, TIME) for name in names)


def texts(*names: str) -> tuple[Field, ...]:
    return tuple(Field(name) for name in names)


def cents(name: str) -> Field:
    return Field(name, DECIMAL, default="0.00")


def amount(name: str) -> Field:
    return Field(name, DOUBLE, default=0.0)


# Columns, defaults and published columns of every entity and version.
FIELDS: dict[tuple[str, int], Sequence[Field]] = {
    ("user", 1): (
        key("id"), key("email", STRING), *texts("phone", "name"), *times("created_at", "last_login_at"),
        Field("status", default="active"), Field("subscription_type", default="free"),
        Field("email_verified", INT, default=0),
    ),
    ("user", 2): (
        key("id"), key("user_token", STRING), *texts("email_token", "phone_token", "name_token", "identity_hash"),
        Field("status", default="active", allowed=USER_STATUS),
        Field("subscription_tier", default="free", allowed=USER_TIER),
        *times("email_verified_at", "created_at", "updated_at", "last_activity_at"),
        *texts("signup_source", "country_code", "timezone"), Field("preferred_language", default="en"),
    ),
    ("activity", 1): (
        key("id"), key("user_id"), key("activity_type", STRING), Field("metadata"), *times("created_at"),
        hidden("ip_address"), hidden("user_agent"),
    ),
    ("activity", 2): (
        key("id"), key("user_id"), key("user_token", STRING),
        key("activity_type", STRING, allowed=ACTIVITY_TYPE), key("created_at", TIME),
        *texts("session_id", "page_path"), hidden("referrer"), Field("duration_seconds", INT),
        *texts("device_type", "platform"), Field("product_id", LONG), Field("category_id", LONG),
        hidden("search_query"),
    ),
    ("order", 1): (
        key("id"), key("user_id"), amount("total_amount"), Field("status", default="pending"),
        *times("created_at", "updated_at"), hidden("shipping_address"), hidden("billing_address"),
        Field("item_count", INT, default=0), hidden("items_json"),
    ),
    ("order", 2): (
        key("id"), key("user_id"), key("user_token", STRING), key("order_number", STRING),
        cents("subtotal"), cents("tax_amount"), cents("shipping_amount"), cents("discount_amount"),
        cents("total_amount"), Field("currency", default="USD", allowed=CURRENCY),
        Field("status", default="pending", allowed=ORDER_STATUS), Field("item_count", INT, default=0),
        *texts("shipping_address_token", "billing_address_token"),
        *times("created_at", "updated_at", "confirmed_at", "shipped_at", "delivered_at"),
        *texts("source", "coupon_code"),
    ),
    ("order_item", 1): (
        key("id"), key("order_id"), key("product_id"), key("product_name", STRING), key("quantity", INT),
        amount("unit_price"), amount("total_price"), hidden("product_sku"), hidden("product_category"),
    ),
    ("order_item", 2): (
        key("id"), key("order_id"), key("product_id"), Field("product_variant_id", LONG),
        Field("quantity", INT, default=1), cents("unit_price"), cents("discount_amount"), cents("tax_amount"),
        cents("total_price"), *texts("product_name", "product_sku"), Field("is_gift", BOOLEAN, default=False),
        hidden("gift_message"),
    ),
    ("payment", 1): (
        key("id"), key("order_id"), key("user_id"), amount("amount"), Field("currency", default="USD"),
        Field("status", default="pending"), Field("payment_method", default="card"),
        *times("created_at", "processed_at"), hidden("card_number"), hidden("card_expiry"),
        Field("card_last_four"), hidden("cardholder_name"), hidden("billing_address"),
    ),
    ("payment", 2): (
        key("id"), key("order_id"), key("user_id"), key("user_token", STRING), cents("amount"),
        Field("currency", default="USD"), Field("status", default="pending", allowed=PAYMENT_STATUS),
        Field("payment_method", default="card", allowed=PAYMENT_METHOD), *texts("card_token", "card_last_four"),
        Field("card_brand", allowed=CARD_BRAND), hidden("card_exp_month", INT), hidden("card_exp_year", INT),
        hidden("billing_address_token"), hidden("cardholder_token"), *texts("provider", "provider_transaction_id"),
        hidden("provider_response_code"), *times("created_at", "authorized_at", "captured_at"),
        Field("processing_time_ms", INT), hidden("failure_reason"), hidden("failure_code"),
    ),
    ("refund", 1): (
        key("id"), key("payment_id"), key("order_id"), amount("amount"), Field("reason"),
        Field("status", default="pending"), *times("created_at", "processed_at"),
    ),
    ("refund", 2): (
        key("id"), key("payment_id"), key("order_id"), cents("amount"), Field("currency", default="USD"),
        Field("reason"), Field("status", default="pending"), Field("provider_refund_id"),
        *times("created_at", "processed_at"), Field("initiated_by"),
    ),
    ("notification", 1): (
        key("id"), key("user_id"), key("channel", STRING), key("notification_type", STRING),
        Field("status", default="pending"), hidden("recipient_email"), hidden("recipient_phone"),
        hidden("recipient_name"), hidden("subject"), hidden("body"),
        *times("created_at", "sent_at", "delivered_at", "opened_at", "clicked_at"),
        hidden("failed_at", TIME), hidden("error_message"), hidden("external_id"),
    ),
    ("notification", 2): (
        key("id"), key("user_id"), key("user_token", STRING), key("channel", STRING, allowed=CHANNEL),
        key("notification_type", STRING, allowed=NOTIFICATION_TYPE),
        Field("status", default="pending", allowed=NOTIFICATION_STATUS), Field("template_id"),
        Field("template_version", INT), Field("order_id", LONG), hidden("product_ids"),
        *times("created_at", "queued_at", "sent_at", "delivered_at", "opened_at", "clicked_at", "failed_at"),
        *texts("provider", "provider_message_id"), hidden("failure_reason"), hidden("failure_code"),
        Field("retry_count", INT, default=0), hidden("max_retries", INT, default=3),
        *texts("campaign_id", "correlation_id"),
    ),
}


def fields_of(entity: str, version: int) -> Sequence[Field]:
    try:
        return FIELDS[entity, version]
    except KeyError:
        raise ValueError(f"no schema for {entity!r} version {version}") from None


def struct_of(entity: str, version: int) -> T.StructType:
    """The entity as a Spark schema."""
    return T.StructType([T.StructField(f.name, TYPES[f.kind]) for f in fields_of(entity, version)])
