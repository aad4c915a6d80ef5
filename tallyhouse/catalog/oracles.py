"""Plain SQL for every registered query, written for another engine to check the results.

The SQL follows the definition of each result and not the plan of the query: distinct
counts, joins and windows appear here where the queries use other means.
"""

from __future__ import annotations

import hashlib

from tallyhouse.catalog.queries import AS_OF, SALT
from tallyhouse.sources import entities as E

ORACLES: dict[str, str] = {}

# Written out again, so that a mistake in the library's own patterns shows.
BLANKS = "".join(map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))
EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
PHONE = "[+]?[0-9]{1,3}[ .-]?[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}"
CARD = "[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"


# --- pieces of SQL -------------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _pads(salt: str) -> tuple[str, str]:
    key = salt.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def token(value: str, prefix: str, salt: str = SALT) -> str:
    inner, outer = _pads(salt)
    mac = f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"
    return f"CASE WHEN {value} <> '' THEN '{prefix}_' || substr({mac}, 1, 16) ELSE '' END"


def folded(value: str) -> str:
    return f"trim(lower({value}), {_text(BLANKS)})"


def digits(value: str) -> str:
    return f"regexp_replace({value}, '\\P{{Nd}}', '', 'g')"


def tail4(value: str, cover: str = "") -> str:
    return f"CASE WHEN length({digits(value)}) < 4 THEN '****' ELSE '{cover}' || right({digits(value)}, 4) END"


def masked_email(value: str) -> str:
    return f"regexp_replace({value}, '^([^@])[^@]+@', '\\1***@')"


def percent(part: str, total: str) -> str:
    """Rounded half to even on the exact value of the double."""
    v = f"(({part})::DOUBLE / ({total})::DOUBLE * 100)"
    scaled = f"(CAST(({v} - floor({v})) * 1152921504606846976.0 AS HUGEINT) * 100)"
    unit, half = "1152921504606846976::HUGEINT", "576460752303423488::HUGEINT"
    cents = f"({scaled} // {unit})"
    rest = f"({scaled} % {unit})"
    up = f"CASE WHEN {rest} > {half} OR ({rest} = {half} AND {cents} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CASE WHEN ({total}) <= 0 THEN 0.0::DOUBLE ELSE (floor({v}) * 100 + {cents} + {up})::DOUBLE / 100 END"


def mean6(amount: str) -> str:
    """Mean of a two-place decimal with six places, rounded half up, in whole numbers."""
    return (
        f"CAST((CAST(sum({amount}) * 100 AS HUGEINT) * 20000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000"
    )


def _meaning(column: str, words: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + " END"


MONEY = "CAST({} AS DECIMAL(18,2))"

USERS = f"""
seen AS (
    SELECT o_custkey, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at FROM orders GROUP BY o_custkey
),
shop_users AS (
    SELECT c_custkey AS id,
        {token("c_custkey::VARCHAR", "usr", E.SALT)} AS user_token,
        replace(lower(c_name), '#', '.') || '@shop.test' AS email,
        '+1-555-' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone,
        c_name AS name,
        CASE WHEN last_at >= TIMESTAMP '{E.ACTIVE_FROM}' THEN 'active'
             WHEN last_at >= TIMESTAMP '{E.INACTIVE_FROM}' THEN 'inactive'
             WHEN last_at IS NOT NULL THEN 'churned' ELSE 'pending_verification' END AS status,
        {_meaning("c_mktsegment", E.TIERS)} AS tier,
        c_acctbal > 0 AS verified,
        CASE WHEN c_acctbal > 0 THEN first_at END AS email_verified_at,
        first_at AS created_at, last_at AS last_activity_at,
        'N' || c_nationkey::VARCHAR AS country_code,
        CASE c_custkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'referral' END AS signup_source
    FROM customer LEFT JOIN seen ON o_custkey = c_custkey
)"""

ORDERS = f"""
shop_orders AS (
    SELECT o_orderkey AS id, o_custkey AS user_id,
        'ORD-' || lpad(o_orderkey::VARCHAR, 12, '0') AS order_number,
        {MONEY.format("o_totalprice")} AS total_amount,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'delivered'
             WHEN o_orderstatus = 'F' THEN 'completed'
             WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'refunded'
             WHEN o_orderstatus = 'P' THEN 'cancelled'
             WHEN o_orderpriority = '1-URGENT' THEN 'confirmed'
             WHEN o_orderpriority = '2-HIGH' THEN 'processing'
             WHEN o_orderpriority = '3-MEDIUM' THEN 'shipped' ELSE 'pending' END AS status,
        o_orderdate AS created_at
    FROM orders
)"""

PAYMENTS = f"""
shop_payments AS (
    SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS user_id,
        l_suppkey AS merchant_id, {MONEY.format("l_extendedprice")} AS amount,
        CASE WHEN l_linestatus = 'F' THEN 'success' ELSE 'failed' END AS status,
        {_meaning("l_returnflag", E.METHODS)} AS payment_method,
        CASE WHEN l_linenumber < 7 THEN '4' || lpad(l_orderkey::VARCHAR, 15, '0') END AS card_number,
        CASE WHEN l_linenumber <> 6 THEN 'Holder ' || l_orderkey::VARCHAR END AS cardholder_name,
        'Street ' || l_suppkey::VARCHAR AS billing_address,
        l_quantity::INTEGER AS processing_time_ms, l_shipdate AS created_at, l_returnflag
    FROM lineitem
)"""

NOTES = f"""
reached AS (SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events),
shop_notes AS (
    SELECT event_id AS id, user_id,
        {token("user_id::VARCHAR", "usr", E.SALT)} AS user_token,
        {_meaning("event_type", E.CHANNELS)} AS channel,
        CASE user_id % 3 WHEN 0 THEN 'promotional' WHEN 1 THEN 'order_shipped' ELSE 'system_alert' END AS notification_type,
        CASE WHEN k >= 80 THEN 'clicked' WHEN k >= 50 THEN 'opened' WHEN k >= 10 THEN 'delivered'
             WHEN k >= 5 THEN 'bounced' ELSE 'failed' END AS status,
        ts AS created_at, ts AS sent_at,
        CASE WHEN k >= 10 THEN ts + to_seconds(k) END AS delivered_at,
        CASE WHEN k >= 50 THEN ts + to_seconds(k * 60) END AS opened_at,
        CASE WHEN k >= 80 THEN ts + to_seconds(k * 120) END AS clicked_at,
        CASE WHEN k < 5 THEN ts + to_seconds(1) END AS failed_at,
        k AS retry_count, 3 AS max_retries
    FROM reached
)"""

CONTACTS = f"""
shop_found AS (
    SELECT doc_id AS id, regexp_extract_all(text, '{EMAIL}') AS emails, regexp_extract_all(text, '{PHONE}') AS phones,
        regexp_extract_all(text, '{CARD}') AS cards, source AS name, lang FROM documents
),
shop_contacts AS (
    SELECT id, n, coalesce(emails[n], '') AS email, coalesce(phones[n], '') AS phone, coalesce(cards[n], '') AS card_number, name, lang
    FROM (SELECT *, unnest(range(1, 1 + greatest(1, len(emails), len(phones), len(cards)))) AS n FROM shop_found)
)"""


def define(name: str, body: str, *tables: str, dates: tuple[str, ...] = ()) -> None:
    if dates:
        body = f"SELECT * REPLACE ({', '.join(f'{d}::VARCHAR AS {d}' for d in dates)}) FROM ({body})"
    ORACLES[name] = (f"WITH {', '.join(tables)}\n" if tables else "") + body


# --- sources and lookups -------------------------------------------------------------------

define("param_scan", """
SELECT l_returnflag, l_linestatus, count(*) AS line_count, sum(l_quantity::BIGINT)::BIGINT AS quantity
FROM lineitem
WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '2001-01-01' AND l_returnflag IN ('A', 'R') GROUP BY ALL""")

define("users_by_range", """
SELECT id, email, name, created_at, last_activity_at AS last_login_at, status FROM shop_users
WHERE created_at >= '1995-06-01' AND created_at < '1997-01-01' ORDER BY created_at""", USERS)

define("orders_of_user", """
SELECT id, user_id, total_amount::DOUBLE AS total_amount, status, created_at FROM shop_orders
WHERE user_id = 42 ORDER BY created_at DESC""", ORDERS)

define("user_search", """
SELECT id, email, name, created_at FROM shop_users
WHERE name LIKE '%er.00000004%' OR email LIKE '%er.00000004%' ORDER BY id LIMIT 100""", USERS)

define("user_activity_topk", """
SELECT event_id AS id, user_id, event_type AS activity_type, props AS metadata, ts AS created_at FROM events
WHERE user_id = 42 AND event_type = 'click' ORDER BY ts DESC, event_id DESC LIMIT 1000""")

ORACLES["user_search_of_index"] = ORACLES["user_search"]
define("user_search_of_short_term", """
SELECT id, email, name, created_at FROM shop_users WHERE name LIKE '%99%' OR email LIKE '%99%' ORDER BY id LIMIT 100""", USERS)
ORACLES["orders_of_user_clustered"] = ORACLES["orders_of_user"]
ORACLES["user_activity_clustered"] = ORACLES["user_activity_topk"]

define("merchant_payment_stats", f"""
SELECT merchant_id, count(*) AS total_transactions, sum(amount)::DOUBLE AS total_amount,
    {mean6("amount")} AS avg_amount,
    count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed
FROM shop_payments GROUP BY merchant_id""", PAYMENTS)

define("dynamic_select", "SELECT id, user_id, created_at FROM shop_orders WHERE status = 'shipped'", ORDERS)

# --- conformance ---------------------------------------------------------------------------

define("conform_users_v1", """
SELECT id, email, phone, name, created_at, last_activity_at AS last_login_at, status,
    tier AS subscription_type, verified::INTEGER AS email_verified FROM shop_users""", USERS)

define("conform_users_v2", """
SELECT id, user_token, status, tier AS subscription_tier, email_verified_at, created_at, last_activity_at,
    signup_source, country_code, 'en' AS preferred_language
FROM shop_users WHERE tier IN ('free', 'basic', 'premium', 'enterprise')""", USERS)

define("conform_activity_v1", """
SELECT event_id AS id, user_id, event_type AS activity_type, props AS metadata, ts AS created_at FROM events""")

define("conform_activity_v2", f"""
SELECT event_id AS id, user_id, {token("user_id::VARCHAR", "usr")} AS user_token, event_type AS activity_type,
    ts AS created_at FROM events
WHERE event_type IN ('login', 'logout', 'page_view', 'search', 'product_view', 'add_to_cart', 'checkout_start',
    'purchase', 'review_submit', 'profile_update')""")

define("conform_orders_v1", """
SELECT id, user_id, total_amount::DOUBLE AS total_amount, status, created_at, NULL::TIMESTAMP AS updated_at,
    NULL::VARCHAR AS shipping_address, NULL::VARCHAR AS billing_address, 0 AS item_count,
    NULL::VARCHAR AS items_json FROM shop_orders""", ORDERS)

_FIT = "status IN ('pending', 'confirmed', 'processing', 'shipped', 'delivered', 'cancelled', 'refunded')"

define("conform_orders_v2", f"""
SELECT id, user_id, {token("user_id::VARCHAR", "usr", E.SALT)} AS user_token, order_number,
    0.0::DOUBLE AS subtotal, 0.0::DOUBLE AS tax_amount, 0.0::DOUBLE AS shipping_amount,
    0.0::DOUBLE AS discount_amount, total_amount::DOUBLE AS total_amount, 'USD' AS currency, status, 0 AS item_count,
    NULL::VARCHAR AS shipping_address_token, NULL::VARCHAR AS billing_address_token, created_at,
    NULL::TIMESTAMP AS updated_at, NULL::TIMESTAMP AS confirmed_at, NULL::TIMESTAMP AS shipped_at,
    NULL::TIMESTAMP AS delivered_at, NULL::VARCHAR AS source, NULL::VARCHAR AS coupon_code
FROM shop_orders WHERE {_FIT}""", ORDERS)

define("conform_rejects", f"""
SELECT id, status, 'status: unknown value' AS reasons FROM shop_orders WHERE NOT ({_FIT})""", ORDERS)

define("conform_rejects_payments", """
SELECT id, concat_ws('; ', CASE WHEN id % 17 = 0 THEN 'user_token: required' END,
    CASE WHEN id % 11 = 0 THEN 'amount: not a decimal(18,2)' END, CASE WHEN id % 13 = 0 THEN 'status: unknown value' END) AS reasons
FROM shop_payments WHERE id % 17 = 0 OR id % 11 = 0 OR id % 13 = 0""", PAYMENTS)
define("conform_rejects_notifications", """
SELECT id, concat_ws('; ', CASE WHEN id % 17 = 0 THEN 'user_token: required' END,
    CASE WHEN id % 7 = 0 THEN 'channel: unknown value' WHEN id % 19 = 0 THEN 'channel: required' END,
    CASE WHEN id % 13 = 0 THEN 'status: unknown value' END,
    CASE WHEN id % 11 = 0 THEN 'retry_count: not a int' END) AS reasons
FROM shop_notes WHERE id % 17 = 0 OR id % 7 = 0 OR id % 19 = 0 OR id % 13 = 0 OR id % 11 = 0""", NOTES)

_ITEM = f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id,
    'part ' || l_partkey::VARCHAR AS product_name, l_quantity::INTEGER AS quantity,
    {MONEY.format("l_extendedprice")}::DOUBLE AS unit_price,
    ({MONEY.format("l_extendedprice")} * l_quantity::INTEGER)::DOUBLE AS total_price"""

define("conform_order_items_v1", f"{_ITEM} FROM lineitem")
define("conform_order_items_v2", f"""{_ITEM}, 0.0::DOUBLE AS discount_amount, 0.0::DOUBLE AS tax_amount,
    FALSE AS is_gift FROM lineitem""")

define("conform_payments_v1", """
SELECT id, order_id, user_id, amount::DOUBLE AS amount, 'USD' AS currency, status, payment_method, created_at,
    card_number, cardholder_name, billing_address FROM shop_payments""", PAYMENTS)

_CARD = f"CASE WHEN card_number IS NOT NULL THEN {token('card_number', 'crd')} END"
_LAST4 = f"CASE WHEN card_number IS NOT NULL THEN {tail4('card_number')} END"
_HOLDER = f"CASE WHEN cardholder_name IS NOT NULL THEN {token('cardholder_name', 'nam')} END"

define("conform_payments_v2", f"""
SELECT id, order_id, user_id, amount::DOUBLE AS amount, 'USD' AS currency, status, payment_method,
    {_CARD} AS card_token, {_LAST4} AS card_last_four, {_HOLDER} AS cardholder_token, created_at,
    processing_time_ms FROM shop_payments""", PAYMENTS)

_REFUND = """
SELECT id, id AS payment_id, order_id, amount::DOUBLE AS amount, 'pending' AS status, created_at"""
define("conform_refunds_v1", f"{_REFUND} FROM shop_payments WHERE l_returnflag = 'R'", PAYMENTS)
define("conform_refunds_v2", f"{_REFUND}, 'USD' AS currency FROM shop_payments WHERE l_returnflag = 'R'", PAYMENTS)

define("conform_notifications_v1", """
SELECT id, user_id, channel, notification_type, status, created_at, sent_at, delivered_at, opened_at, clicked_at,
    failed_at FROM shop_notes""", NOTES)

define("conform_notifications_v2", """
SELECT id, user_id, user_token, channel, notification_type, status, sent_at, delivered_at, opened_at, clicked_at,
    failed_at, retry_count, max_retries FROM shop_notes""", NOTES)

define("publish_users_v1", f"""
SELECT id, {token(folded("email"), "eml")} AS email_token, {token(digits("phone"), "phn")} AS phone_token,
    {token(folded("name"), "nam")} AS name_token, created_at, last_activity_at AS last_login_at, status,
    tier AS subscription_type, verified::INTEGER AS email_verified FROM shop_users""", USERS)

define("publish_orders", f"""
SELECT id, user_id, order_number, '0.00' AS subtotal, total_amount::VARCHAR AS total_amount, 'USD' AS currency,
    status, 0 AS item_count, created_at FROM shop_orders WHERE {_FIT}""", ORDERS)

define("publish_payments", f"""
SELECT id, order_id, amount::VARCHAR AS amount, 'USD' AS currency, status, payment_method,
    {_CARD} AS card_token, {_LAST4} AS card_last_four FROM shop_payments""", PAYMENTS)

define("flatten_struct", """
SELECT c_custkey AS id, c_name AS profile_name, c_nationkey AS profile_place_nation,
    c_mktsegment AS profile_place_segment, c_acctbal AS account_balance FROM customer""")

define("safe_projection", "SELECT id, user_token, status, created_at, country_code FROM shop_users", USERS)

define("required_fields_check", """
SELECT 'id' AS field, count(id) AS passed, count(*) - count(id) AS failed FROM shop_payments
UNION ALL SELECT 'amount', count(amount), count(*) - count(amount) FROM shop_payments
UNION ALL SELECT 'card_number', count(card_number), count(*) - count(card_number) FROM shop_payments
UNION ALL SELECT 'cardholder_name', count(cardholder_name), count(*) - count(cardholder_name) FROM shop_payments
UNION ALL SELECT 'created_at', count(created_at), count(*) - count(created_at) FROM shop_payments
UNION ALL SELECT '(all)', count(*) FILTER (ok), count(*) FILTER (NOT ok) FROM (
    SELECT id IS NOT NULL AND amount IS NOT NULL AND card_number IS NOT NULL AND cardholder_name IS NOT NULL
        AND created_at IS NOT NULL AS ok FROM shop_payments)""", PAYMENTS)

# --- state flags and row checks ------------------------------------------------------------

define("user_state_flags", """
SELECT id, email_verified_at IS NOT NULL AS is_verified, tier IN ('premium', 'enterprise') AS is_premium
FROM shop_users""", USERS)

define("order_state_flags", """
SELECT id, status, status = 'delivered' AS is_completed,
    status IN ('pending', 'confirmed', 'processing', 'shipped') AS is_active FROM shop_orders""", ORDERS)

define("payment_state_flags", """
SELECT merchant_id, status, status IN ('success', 'captured') AS is_successful,
    status IN ('success', 'captured') AS is_refundable, count(*) AS rows FROM shop_payments GROUP BY ALL""", PAYMENTS)

define("notification_state_flags", """
SELECT id, status, status IN ('delivered', 'opened', 'clicked') AS is_delivered,
    status IN ('opened', 'clicked') AS is_engaged, status = 'failed' AND retry_count < 3 AS can_retry
FROM shop_notes""", NOTES)

define("notification_state_flags_v1", """
SELECT id, delivered_at IS NOT NULL AS is_delivered, opened_at IS NOT NULL AS is_opened,
    clicked_at IS NOT NULL AS is_clicked FROM shop_notes""", NOTES)

define("retry_queue", """
SELECT id, user_id, channel, retry_count FROM shop_notes WHERE status = 'failed' AND retry_count < 3""", NOTES)

define("delivery_latency", """
SELECT id, CASE WHEN delivered_at IS NOT NULL THEN (epoch_us(delivered_at) - epoch_us(sent_at)) // 1000 END::DOUBLE
    AS delivery_time_ms FROM shop_notes""", NOTES)

define("email_validity", f"""
SELECT id, email, regexp_full_match(email, '{EMAIL}') AS is_valid
FROM (SELECT doc_id AS id, unnest(regexp_extract_all(text, '[^ \\t\\n\\r]*@[^ \\t\\n\\r]*')) AS email FROM documents)""")

define("report_format", """
SELECT id,
    CASE status WHEN 'pending' THEN '€' || money WHEN 'shipped' THEN '£' || money
        WHEN 'cancelled' THEN money || ' JPY' ELSE '$' || money END AS amount_text,
    left(order_number, 9) || '...' AS short_number,
    CASE WHEN id = 0 THEN 0.0 ELSE user_id::DOUBLE / id::DOUBLE END AS ratio
FROM (SELECT *, format('{:,}', (total_amount::VARCHAR).split_part('.', 1)::BIGINT) || '.'
    || split_part(total_amount::VARCHAR, '.', 2) AS money FROM shop_orders)""", ORDERS)

define("text_preview", """
SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE substr(text, 1, 97) || '...' END AS preview
FROM documents""")

# --- users ---------------------------------------------------------------------------------

_REGISTERED = """
SELECT created_at::DATE AS registration_date, count(*) AS total_registrations,
    count(*) FILTER (verified) AS verified_users, count(*) FILTER (tier = 'premium') AS premium_signups{more}
FROM shop_users WHERE created_at IS NOT NULL GROUP BY 1 ORDER BY 1"""

define("registration_daily", _REGISTERED.format(
    more=", count(*) FILTER (tier = 'enterprise') AS enterprise_signups"), USERS, dates=("registration_date",))
define("registration_daily_inline", _REGISTERED.format(more=""), USERS, dates=("registration_date",))
define("registration_daily_v1", _REGISTERED.format(more=""), USERS, dates=("registration_date",))

_ACTIVE = """
FROM shop_users u LEFT JOIN events a ON u.id = a.user_id WHERE u.created_at IS NOT NULL"""

define("user_activity", f"""
SELECT u.id AS user_id, u.user_token, count(a.event_id) AS activity_count, max(a.ts) AS last_activity,
    array_to_string(list_sort(list(DISTINCT a.event_type)), ',') AS activity_types
{_ACTIVE} GROUP BY u.id, u.user_token HAVING count(a.event_id) > 0""", USERS)

define("user_activity_v1", f"""
SELECT {token(folded("email"), "eml")} AS email_token, {token(folded("name"), "nam")} AS name_token,
    activity_count, last_activity
FROM (SELECT u.email, u.name, count(a.event_id) AS activity_count, max(a.ts) AS last_activity
    {_ACTIVE} GROUP BY u.email, u.name HAVING count(a.event_id) > 0)""", USERS)

define("churn_by_status", """
SELECT status, count(*) AS user_count, avg(days) AS avg_days_active, quantile_cont(days::DOUBLE, 0.5) AS median_days_active
FROM (SELECT status, extract(DAY FROM (last_activity_at - created_at)) AS days FROM shop_users
    WHERE status IN ('active', 'inactive', 'churned') AND created_at IS NOT NULL)
GROUP BY status""", USERS)

define("churn_by_status_v1", """
SELECT status, count(*) AS user_count, avg(date_diff('day', created_at, last_activity_at)) AS avg_days_active
FROM shop_users WHERE status IN ('active', 'churned', 'dormant') AND created_at IS NOT NULL GROUP BY status""", USERS)

_TOTALS = """
totals AS (SELECT user_id, count(*) AS n, sum(total_amount) AS spend FROM shop_orders GROUP BY user_id)"""

define("user_segments", """
SELECT segment, count(*) AS user_count, avg(n) AS avg_orders,
    sum(spend)::DOUBLE / count(*) AS avg_spend, sum(spend)::DOUBLE AS segment_revenue
FROM (SELECT CASE WHEN coalesce(n, 0) >= 10 THEN 'high_value' WHEN coalesce(n, 0) >= 5 THEN 'medium_value'
        WHEN coalesce(n, 0) >= 1 THEN 'low_value' ELSE 'no_orders' END AS segment,
        coalesce(n, 0) AS n, coalesce(spend, 0) AS spend
    FROM shop_users LEFT JOIN totals ON totals.user_id = shop_users.id WHERE created_at IS NOT NULL)
GROUP BY segment""", USERS, ORDERS, _TOTALS)

define("user_segments_of_few_buyers", """
SELECT segment, count(*) AS user_count, avg(n) AS avg_orders, sum(spend)::DOUBLE / count(*) AS avg_spend, sum(spend)::DOUBLE AS segment_revenue
FROM (SELECT CASE WHEN n >= 10 THEN 'high_value' WHEN n >= 5 THEN 'medium_value' WHEN n >= 1 THEN 'low_value' ELSE 'no_orders' END AS segment, n, spend
    FROM (SELECT shop_users.id, count(event_id) AS n, coalesce(sum(floor(value)), 0) AS spend
        FROM shop_users LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase' AND extract(MINUTE FROM ts) < 30) ON user_id = shop_users.id
        WHERE created_at IS NOT NULL GROUP BY shop_users.id))
GROUP BY segment""", USERS)

define("user_segments_detail", f"""
SELECT CASE WHEN n >= 10 THEN 'high_value' WHEN n >= 5 THEN 'medium_value' ELSE 'low_value' END AS segment,
    {token(folded("email"), "eml")} AS email_token, {token(digits("phone"), "phn")} AS phone_token,
    n AS total_orders, spend::DOUBLE AS total_spend
FROM (SELECT u.email, u.phone, count(o.id) AS n, sum(o.total_amount) AS spend
    FROM shop_users u LEFT JOIN shop_orders o ON u.id = o.user_id WHERE u.created_at IS NOT NULL
    GROUP BY u.email, u.phone)""", USERS, ORDERS)

_DUPLICATES = """
SELECT {name}, size AS duplicate_count, id AS duplicate_id
FROM (SELECT *, count(*) OVER (PARTITION BY {name}) AS size FROM ({source})) WHERE size > 1"""

define("duplicate_identities", _DUPLICATES.format(
    name="identity_hash", source="SELECT doc_id AS id, sha256(text) AS identity_hash FROM documents"))
define("duplicate_identities_v1", _DUPLICATES.format(
    name="user_hash", source="SELECT id, md5(email || phone || name) AS user_hash FROM shop_contacts"), CONTACTS)

_COHORT = """
cohort AS (SELECT id AS user_id, date_trunc('month', created_at)::DATE AS cohort_month FROM shop_users
    WHERE created_at IS NOT NULL),
months AS (SELECT o_custkey AS user_id, date_trunc('month', o_orderdate)::DATE AS activity_month FROM orders)"""

define("cohort_retention", """
SELECT c.cohort_month, m.activity_month, count(DISTINCT c.user_id) AS active_users,
    count(DISTINCT c.user_id)::DOUBLE / max(s.size) * 100 AS retention_rate
FROM cohort c JOIN months m ON c.user_id = m.user_id
JOIN (SELECT cohort_month, count(*) AS size FROM cohort GROUP BY 1) s ON s.cohort_month = c.cohort_month
GROUP BY 1, 2 ORDER BY 1, 2""", USERS, _COHORT, dates=("cohort_month", "activity_month"))

define("cohort_activity", """
SELECT c.cohort_month, m.activity_month, count(DISTINCT c.user_id) AS active_users
FROM cohort c JOIN months m ON c.user_id = m.user_id GROUP BY 1, 2 ORDER BY 1, 2""", USERS, _COHORT, dates=("cohort_month", "activity_month"))

define("daily_active_users", """
SELECT a.ts::DATE AS activity_date, count(DISTINCT a.user_id) AS dau,
    count(DISTINCT CASE WHEN u.tier = 'premium' THEN a.user_id END) AS premium_dau,
    count(DISTINCT CASE WHEN u.tier = 'enterprise' THEN a.user_id END) AS enterprise_dau
FROM events a JOIN shop_users u ON a.user_id = u.id GROUP BY 1 ORDER BY 1""", USERS, dates=("activity_date",))

for _name, _period in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
    define(f"{_name}_actives_of_bitmaps", f"""
SELECT date_trunc('{_period}', a.ts)::DATE AS period_start, count(DISTINCT a.user_id) AS users,
    count(DISTINCT CASE WHEN u.tier = 'premium' THEN a.user_id END) AS premium_users,
    count(DISTINCT CASE WHEN u.tier = 'enterprise' THEN a.user_id END) AS enterprise_users
FROM events a JOIN shop_users u ON a.user_id = u.id GROUP BY 1""", USERS, dates=("period_start",))

ORACLES["user_segments_of_buckets"] = ORACLES["user_segments_detail"]
ORACLES["cohort_retention_of_buckets"] = ORACLES["cohort_retention"]

_SINCE = f"CAST(floor(epoch(TIMESTAMP '{AS_OF}' - last_activity_at) / 86400.0) AS BIGINT)"

define("user_metrics_v1", f"""
SELECT DISTINCT id AS user_id, created_at AS registration_date, status, tier AS subscription_type,
    verified AS email_verified, {_SINCE} AS days_since_last_login
FROM shop_users WHERE created_at IS NOT NULL""", USERS)

_USER_METRICS = f"""
SELECT DISTINCT user_token, created_at AS registration_date, status, tier AS subscription_tier,
    email_verified_at IS NOT NULL AS email_verified, {_SINCE} AS days_since_last_activity, country_code, signup_source
FROM shop_users WHERE created_at IS NOT NULL"""
define("user_metrics_v2", _USER_METRICS, USERS)
for _name in ("load_user_analytics", "backfill_users_one_scan", "merged_user_analytics"):
    define(_name, _USER_METRICS, USERS)

# --- orders, payments, notifications -------------------------------------------------------

_ORDER_DAY = f"""
order_days AS (
    SELECT created_at::DATE AS order_date, status, count(*) AS order_count, sum(total_amount) AS total_revenue,
        {mean6("total_amount")} AS avg_order_value
    FROM shop_orders WHERE status IN ('completed', 'pending', 'cancelled') GROUP BY 1, 2
)"""

_ORDER_NUMBERS = """
SELECT order_date, status, order_count, total_revenue::DOUBLE AS total_revenue, avg_order_value
FROM order_days ORDER BY 1, 2"""
define("order_daily", _ORDER_NUMBERS, ORDERS, _ORDER_DAY, dates=("order_date",))
define("order_metrics_v1", _ORDER_NUMBERS, ORDERS, _ORDER_DAY, dates=("order_date",))

_ORDER_TEXT = """
SELECT order_date, status, order_count, total_revenue::VARCHAR AS total_revenue,
    avg_order_value::DECIMAL(22,6)::VARCHAR AS avg_order_value FROM order_days"""
for _name in ("order_metrics_v2", "order_metrics_of_repeats", "append_if_absent_rows", "load_order_analytics",
              "backfill_one_scan", "merged_order_analytics", "stream_merged_orders"):
    define(_name, _ORDER_TEXT, ORDERS, _ORDER_DAY, dates=("order_date",))
define("backfill_load", _ORDER_TEXT + " WHERE order_date >= '1996-01-01' AND order_date < '1996-03-27'", ORDERS, _ORDER_DAY, dates=("order_date",))

_PAYMENT_DAY = """
payment_days AS (
    SELECT created_at::DATE AS payment_date, payment_method, count(*) AS transaction_count, sum(amount) AS total_amount,
        count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
        avg(CASE WHEN status = 'success' THEN processing_time_ms END) AS avg_processing_time
    FROM shop_payments GROUP BY 1, 2
)"""

define("payment_daily", """
SELECT payment_date, payment_method, transaction_count, total_amount::DOUBLE AS total_amount, successful, failed,
    avg_processing_time FROM payment_days ORDER BY 1, 2""", PAYMENTS, _PAYMENT_DAY, dates=("payment_date",))

_PAYMENT_METRICS = f"""
SELECT payment_date, payment_method, transaction_count, total_amount::VARCHAR AS total_amount,
    successful AS successful_count, failed AS failed_count, {percent("successful", "transaction_count")} AS success_rate,
    avg_processing_time AS avg_processing_time_ms FROM payment_days"""
define("payment_metrics", _PAYMENT_METRICS, PAYMENTS, _PAYMENT_DAY, dates=("payment_date",))
define("payment_metrics_of_repeats", _PAYMENT_METRICS, PAYMENTS, _PAYMENT_DAY, dates=("payment_date",))
for _name in ("load_payment_analytics", "merged_payment_analytics"):
    define(_name, _PAYMENT_METRICS, PAYMENTS, _PAYMENT_DAY, dates=("payment_date",))

_NOTE_DAY = """
note_days AS (
    SELECT sent_at::DATE AS notification_date, channel, notification_type, count(*) AS total_sent,
        count(delivered_at) AS delivered, count(opened_at) AS opened, count(clicked_at) AS clicked,
        count(*) FILTER (status = 'bounced') AS bounced, count(*) FILTER (status = 'failed') AS failed
    FROM shop_notes WHERE channel IN ('email', 'sms', 'push') GROUP BY 1, 2, 3
)"""

define("notification_daily", "SELECT * FROM note_days ORDER BY 1, 2", NOTES, _NOTE_DAY, dates=("notification_date",))

_RATES = f"""{percent("delivered", "total_sent")} AS delivery_rate, {percent("opened", "delivered")} AS open_rate,
    {percent("clicked", "opened")} AS click_rate"""
_NOTE_METRICS = f"""
SELECT notification_date, channel, notification_type, total_sent, delivered, opened, clicked, {_RATES},
    {percent("clicked", "total_sent")} AS click_through_rate{{more}} FROM note_days"""
for _name in ("notification_metrics", "notification_metrics_of_repeats"):
    define(_name, _NOTE_METRICS.format(more=", bounced, failed"), NOTES, _NOTE_DAY, dates=("notification_date",))
for _name in ("load_notification_analytics", "merged_notification_analytics"):
    define(_name, _NOTE_METRICS.format(more=", bounced, failed"), NOTES, _NOTE_DAY, dates=("notification_date",))
define("notification_metrics_v1", _NOTE_METRICS.format(more=""), NOTES, _NOTE_DAY, dates=("notification_date",))

_CHANNEL = f"""
SELECT *, {_RATES}{{more}} FROM (
    SELECT channel, sum(total_sent)::BIGINT AS total_sent, sum(delivered)::BIGINT AS delivered,
        sum(opened)::BIGINT AS opened, sum(clicked)::BIGINT AS clicked FROM note_days GROUP BY channel)"""
define("channel_metrics", _CHANNEL.format(more=""), NOTES, _NOTE_DAY)
define("load_channel_analytics", _CHANNEL.format(
    more=", TIMESTAMP '1990-01-01' AS window_start, TIMESTAMP '2030-01-01' AS window_end"), NOTES, _NOTE_DAY)

define("backfill_channel_windows", f"""
SELECT *, {_RATES} FROM (
    SELECT channel, sum(total_sent)::BIGINT AS total_sent, sum(delivered)::BIGINT AS delivered, sum(opened)::BIGINT AS opened,
        sum(clicked)::BIGINT AS clicked, TIMESTAMP '1990-01-01' + to_days((7 * week)::INT) AS window_start,
        least(TIMESTAMP '1990-01-01' + to_days((7 * week + 7)::INT), TIMESTAMP '2030-01-01') AS window_end
    FROM (SELECT *, date_diff('day', DATE '1990-01-01', notification_date) // 7 AS week FROM note_days) GROUP BY channel, week)""", NOTES, _NOTE_DAY)

define("backfill_outcomes", """
SELECT 'payment_analytics' AS job_name, CASE WHEN gone THEN 'failed' ELSE 'success' END AS status, n AS records_extracted,
    n AS records_loaded, 0::BIGINT AS records_skipped, 0::BIGINT AS records_failed, window_start, window_end, gone::INT AS error_count
FROM (
    SELECT window_start, window_end, TIMESTAMP '1996-02-05' >= window_start AND TIMESTAMP '1996-02-05' < window_end AS gone,
        CASE WHEN gone THEN 0 ELSE count(payment_date) END AS n
    FROM (SELECT TIMESTAMP '1990-01-01' + to_days((28 * i)::INT) AS window_start,
            least(TIMESTAMP '1990-01-01' + to_days((28 * i + 28)::INT), TIMESTAMP '2030-01-01') AS window_end
        FROM range((date_diff('day', DATE '1990-01-01', DATE '2030-01-01') + 27) // 28) AS t(i))
    LEFT JOIN payment_days ON payment_date >= window_start AND payment_date < window_end GROUP BY 1, 2)""", PAYMENTS, _PAYMENT_DAY)

# --- privacy -------------------------------------------------------------------------------

define("tokenize_column", f"SELECT id, n, {token('card_number', 'crd')} AS card_number FROM shop_contacts", CONTACTS)

define("tokenize_contacts", f"""
SELECT id, {token("id::VARCHAR", "usr")} AS user_token, {token(folded("email"), "eml")} AS email_token,
    {token(digits("phone"), "phn")} AS phone_token, {token(folded("name"), "nam")} AS name_token
FROM shop_users""", USERS)

define("tokenize_payments", f"""
SELECT id, amount::DOUBLE AS amount, {_CARD} AS card_token, {_LAST4} AS card_last_four, {_HOLDER} AS cardholder_token,
    {token("billing_address", "adr")} AS billing_token FROM shop_payments""", PAYMENTS)

define("mask_payments", f"""
SELECT id, {tail4("coalesce(card_number, '')", "****-****-****-")} AS card_display FROM shop_payments""", PAYMENTS)

_HIDE = "CASE WHEN {0} <> '' THEN '[REDACTED]' ELSE {0} END AS {0}"
define("redact_table", f"""
SELECT id, n, lang, {_HIDE.format("email")}, {_HIDE.format("phone")}, {_HIDE.format("card_number")},
    {_HIDE.format("name")} FROM shop_contacts""", CONTACTS)

define("redact_table_v1", """
SELECT id, n, '[REDACTED]' AS email, '[REDACTED]' AS phone, card_number, '[REDACTED]' AS name, lang
FROM shop_contacts""", CONTACTS)

define("salted_hash", f"SELECT id, sha256({_text(SALT)} || email) AS email_hash FROM shop_users", USERS)

define("payment_pii_stage", f"""
SELECT mode, payment_method, count(*) AS payments, count(DISTINCT card) AS cards, sum(('0x' || substr(md5(card), 1, 6))::BIGINT)::BIGINT AS print
FROM (SELECT 'token' AS mode, payment_method, CASE WHEN card_number IS NOT NULL THEN {token('card_number', 'crd')} END AS card FROM shop_payments
    UNION ALL SELECT 'mask', payment_method, {tail4("coalesce(card_number, '')", "****-****-****-")} FROM shop_payments)
GROUP BY ALL""", PAYMENTS)

define("mask_contacts", f"""
SELECT id, n, {masked_email("email")} AS email, {tail4("phone", "***-***-")} AS phone,
    {tail4("card_number", "****-****-****-")} AS card_number, name, lang FROM shop_contacts""", CONTACTS)

define("hash_contacts", """
SELECT id, n, email, phone, md5(email) AS email_md5, sha1(email) AS email_sha1, md5(phone) AS phone_md5,
    sha1(phone) AS phone_sha1 FROM shop_contacts""", CONTACTS)

define("anonymize_users", f"""
SELECT id, status, {masked_email("email")} AS email_masked, md5(email) AS email_hash,
    {tail4("phone", "***-***-")} AS phone_masked, md5(phone) AS phone_hash, md5(name) AS name_hash
FROM shop_users""", USERS)

define("contact_features", """
SELECT id, n, CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) END AS email_domain,
    nullif(regexp_extract(phone, '^\\+([0-9]{1,3})', 1), '') AS phone_country_code FROM shop_contacts""", CONTACTS)

define("sanitize_nested", """
SELECT id, '[REDACTED]' AS profile_email, status AS profile_status, '[REDACTED]' AS profile_reach_phone,
    country_code AS profile_reach_country_code, '[REDACTED]' AS user_token FROM shop_users""", USERS)

# --- fingerprints and duplicates -----------------------------------------------------------

define("record_fingerprint", """
SELECT doc_id, sha256(to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars, 'source': source, 'text': text})::VARCHAR)
    AS fingerprint FROM documents""")

_FIELDS = "concat_ws('|', '', o_custkey::VARCHAR, o_orderpriority, o_orderstatus)"
define("field_fingerprint", f"SELECT o_orderkey, sha256({_FIELDS}) AS sha256, md5({_FIELDS}) AS md5 FROM orders")

_PERSON = f"{folded('email')} || '|' || trim(phone, {_text(BLANKS)}) || '|' || {folded('name')}"
define("identity_hash", f"SELECT id, sha256({_PERSON}) AS sha256, md5({_PERSON}) AS md5 FROM shop_users", USERS)

_PRINTS = "prints AS (SELECT *, sha256(text) AS fingerprint FROM documents)"
_KNOWN = "known AS (SELECT DISTINCT fingerprint FROM prints JOIN labels USING (doc_id){where})"

define("known_duplicates", """
SELECT doc_id, fingerprint FROM prints WHERE fingerprint IN (SELECT fingerprint FROM known)""",
       _PRINTS, _KNOWN.format(where=""))

define("mark_new", """
SELECT doc_id, fingerprint, row_number() OVER (PARTITION BY fingerprint ORDER BY doc_id) = 1
    AND fingerprint NOT IN (SELECT fingerprint FROM known) AS is_new FROM prints""",
       _PRINTS, _KNOWN.format(where=" WHERE quality = 0"))

_FIRST = """
SELECT doc_id, lang, source, n_chars, fingerprint FROM prints
WHERE doc_id IN (SELECT min(doc_id) FROM prints GROUP BY fingerprint)"""
define("dedup_records", _FIRST, _PRINTS)
define("dedup_new_records", _FIRST + " AND fingerprint NOT IN (SELECT fingerprint FROM known)",
       _PRINTS, _KNOWN.format(where=" WHERE quality = 1"))
define("dedup_batches", """
SELECT min(doc_id) AS doc_id, fingerprint FROM prints
WHERE fingerprint NOT IN (SELECT fingerprint FROM known) GROUP BY fingerprint""",
       _PRINTS, _KNOWN.format(where=""))
ORACLES["dedup_known_store"] = ORACLES["dedup_batches"]
ORACLES["known_store_lookup"] = ORACLES["known_duplicates"]
define("dedup_repeated_batch", "SELECT DISTINCT * FROM events")

# --- windows, loading, jobs ----------------------------------------------------------------

define("previous_day_slice", "SELECT * FROM events WHERE ts >= '2024-01-14' AND ts < '2024-01-15'")
define("previous_hour_slice", """
SELECT * FROM events WHERE ts >= '2024-01-15 09:00:00' AND ts < '2024-01-15 10:00:00'""")

define("backfill_chunks", """
SELECT chunk, TIMESTAMP '1994-12-30' + to_days(chunk * 7) AS chunk_start,
    least(TIMESTAMP '1994-12-30' + to_days(chunk * 7 + 7), TIMESTAMP '2001-06-15 18:00:00') AS chunk_end,
    count(*) AS rows
FROM (SELECT CAST(floor(date_diff('day', DATE '1994-12-30', created_at::DATE) / 7.0) AS INTEGER) AS chunk FROM shop_orders
    WHERE created_at >= '1994-12-30' AND created_at < '2001-06-15 18:00:00')
GROUP BY chunk ORDER BY chunk""", ORDERS)

_STATE_DAY = """
{name} AS (SELECT created_at::DATE AS order_date, status, count(*) AS n, sum(total_amount) AS total
    FROM shop_orders WHERE status IN ('completed', 'pending', 'cancelled') AND NOT ({without}) GROUP BY 1, 2)"""
define("load_differences", """
SELECT coalesce(a.order_date, b.order_date) AS order_date, coalesce(a.status, b.status) AS status,
    CASE WHEN b.n IS NULL THEN 'absent' WHEN a.n IS NULL THEN 'extra' ELSE 'changed' END AS state
FROM wanted a FULL JOIN loaded b ON a.order_date = b.order_date AND a.status = b.status
WHERE a.n IS DISTINCT FROM b.n OR a.total IS DISTINCT FROM b.total""", ORDERS,
       _STATE_DAY.format(name="wanted", without="created_at >= '1997-07-01' AND created_at < '1997-08-01' AND status = 'cancelled'"),
       _STATE_DAY.format(name="loaded", without="""created_at >= '1996-02-01' AND created_at < '1996-03-01' AND total_amount < 100000
        OR created_at >= '1996-05-10' AND created_at < '1996-05-11'"""), dates=("order_date",))

_LISTED = """'[[{"k":' || user_id || ',"phone":"' || PHONE || '"}],"' || event_type || '"]'"""
define("sanitize_records", f"""
SELECT event_id, '{{' || array_to_string(list_sort(['"kind":"' || event_type || '"', '"' || event_type || '_token":"[REDACTED]"',
    '"props":{{"k":' || json_extract(props, '$.k') || '}}', '"at":{{' || array_to_string(list_sort(['"user_Email":"[REDACTED]"',
        '"' || event_type || '":' || {_LISTED.replace("PHONE", "'[REDACTED]'")}]), ',') || '}}']), ',') || '}}' AS record FROM events""")
define("flatten_records", f"""
SELECT event_id, unnest(['kind', event_type || '_token', 'at_user_Email', 'at_' || event_type, 'props_k']) AS path,
    unnest([event_type, user_id::VARCHAR, 'u' || user_id || '@shop.test', {_LISTED.replace("PHONE", "'1'")}, json_extract(props, '$.k')::VARCHAR]) AS value
FROM events""")

define("sanitize_maps", """
SELECT event_id, event_type AS kind, '[REDACTED]' AS user_email, event_type AS step, '[REDACTED]' AS phone FROM events""")
define("record_fingerprint_nested", "SELECT event_id, true AS same, 64::BIGINT AS digits FROM events")

_COUNTED = """
SELECT '{job}' AS job_name, 'success' AS status, count(*) AS records_extracted, count(*) AS records_transformed,
    count(*) AS records_loaded, count(*) AS records_processed, 0::BIGINT AS records_skipped, 0::BIGINT AS records_failed,
    TIMESTAMP '1990-01-01' AS window_start, TIMESTAMP '2030-01-01' AS window_end, 0 AS error_count FROM {rows}"""
define("run_summary", " UNION ALL ".join([
    _COUNTED.format(job="user_analytics", rows="shop_users WHERE created_at IS NOT NULL"),
    _COUNTED.format(job="order_analytics", rows="order_days"),
    _COUNTED.format(job="payment_analytics", rows="payment_days"),
    _COUNTED.format(job="notification_analytics", rows="note_days"),
    "SELECT 'refund_analytics', 'failed', 0, 0, 0, 0, 0, 0, NULL, NULL, 1",
]), USERS, ORDERS, _ORDER_DAY, PAYMENTS, _PAYMENT_DAY, NOTES, _NOTE_DAY)

# --- streams: all windows, also those still open when the input ends ------------------------

define("stream_dedup", """
SELECT min(event_id) AS event_id, sha256(user_id::VARCHAR || '|' || event_type) AS fingerprint, user_id, event_type
FROM events GROUP BY user_id, event_type""")
define("stream_dedup_within_delay", """
SELECT DISTINCT sha256(user_id::VARCHAR || '|' || event_type) AS fingerprint, user_id, event_type FROM events""")
define("stream_append", "SELECT DISTINCT ts::DATE AS day, user_id, event_type FROM events", dates=("day",))



def _windows(unit: str, at: str, keys: str, figures: str, table: str) -> str:
    return f"""
SELECT * FROM (
    SELECT date_trunc('{unit}', {at})::TIMESTAMP AS window_start,
        (date_trunc('{unit}', {at}) + INTERVAL 1 {unit})::TIMESTAMP AS window_end, {keys}, {figures}
    FROM {table} GROUP BY date_trunc('{unit}', {at}), {keys})"""


define("stream_notification_windows", _windows("hour", "sent_at", "channel, notification_type", """
        count(*) AS total_sent, count(delivered_at) AS delivered, count(opened_at) AS opened,
        count(clicked_at) AS clicked""", "shop_notes"), NOTES)

define("stream_order_windows", _windows("day", "created_at", "status", """
        count(*) AS order_count, sum(total_amount)::DOUBLE AS total_revenue""", "shop_orders"), ORDERS)

define("stream_payment_windows", _windows("day", "created_at", "payment_method", """
        count(*) AS transaction_count, sum(amount)::DOUBLE AS total_amount,
        count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
        avg(CASE WHEN status = 'success' THEN processing_time_ms END) AS avg_processing_time""",
    "shop_payments"), PAYMENTS)
