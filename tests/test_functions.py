"""Column functions against plain Python on the same values."""

import hashlib
import hmac
from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.functions import numbers, secrets, text, time


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, schema, rows, column):
    return [r[0] for r in values(spark, schema, rows, column)]


def test_percent_equals_exact_rounding(spark):
    rows = [(n, d) for d in (4000, 20000) for n in range(d + 1)]
    rows += [(n, d) for d in range(1, 200) for n in range(0, d + 1)]
    rows += [(n, d) for d in (8000, 12000, 999_983, 10**9 + 7) for n in range(0, d + 1, d // 911)]
    got = one(spark, "n long, d long", rows, numbers.percent(F.col("n"), F.col("d")))
    assert got == [round(n / d * 100, 2) for n, d in rows]


def test_percent_of_nothing(spark):
    rows = [(5, 0), (5, -1), (0, 0)]
    assert one(spark, "n long, d long", rows, numbers.percent(F.col("n"), F.col("d"))) == [0.0, 0.0, 0.0]


def test_rounding_of_negative_and_large_values(spark):
    rows = [(-0.025,), (-12.345,), (0.0,), (123456789.125,), (1e12 + 0.5,)]
    assert one(spark, "v double", rows, numbers.round_cents(F.col("v"))) == [round(v, 2) for (v,) in rows]


def test_divide_and_throughput(spark):
    rows = [(1.0, 4.0), (1.0, 0.0), (None, 2.0)]
    assert one(spark, "n double, d double", rows, numbers.divide_or(F.col("n"), F.col("d"), 9.0)) == [0.25, 9.0, None]
    assert one(spark, "n double, d double", rows[:2], numbers.per_second(F.col("n"), F.col("d"))) == [0.25, 0.0]


@pytest.mark.parametrize("amount, code, shown", [
    ("1234567.5", "USD", "$1,234,567.50"), ("-5", "EUR", "€-5.00"), ("0", "GBP", "£0.00"), ("12.3", "JPY", "12.30 JPY"),
])
def test_currency_text(spark, amount, code, shown):
    row = [(amount, code)]
    column = numbers.currency_text(F.col("a").cast("decimal(18,2)"), F.col("c"))
    assert one(spark, "a string, c string", row, column) == [shown]


def test_strip_removes_all_white_space(spark):
    rows = [("\t a b \n",), ("　x ",), ("\x1cy\x85",), ("",), (None,)]
    assert one(spark, "v string", rows, text.strip(F.col("v"))) == ["a b", "x", "y", "", None]


def test_digits_of_any_script(spark):
    rows = [("+1 (555) 123-4567",), ("٣a4",), ("none",)]
    assert one(spark, "v string", rows, text.digits_only(F.col("v"))) == ["15551234567", "٣4", ""]


@pytest.mark.parametrize("value, valid", [
    ("john.doe@example.com", True), ("a+b%c@x-y.co", True), ("a@b.com\n", True), ("a@b.com\r\n", False), ("a@b", False),
    ("@b.com", False), ("a b@c.de", False), ("x a@b.com", False), ("", False),
])
def test_email_shape(spark, value, valid):
    assert one(spark, "v string", [(value,)], text.is_email(F.col("v"))) == [valid]


def test_shorten_keeps_the_limit(spark):
    rows = [("a" * n,) for n in (0, 9, 10, 11, 50)] + [("\U0001f600" * 11,)]
    got = one(spark, "v string", rows, text.shorten(F.col("v"), 10))
    assert got == [v if len(v) <= 10 else v[:7] + "..." for (v,) in rows]


@pytest.mark.parametrize("salt", ["test-salt", "s" * 64, "long" * 40, "sälz"])
def test_token_is_hmac(spark, salt):
    rows = [("user@example.com",), ("Zoë",), ("",), (None,), ("\U0001f600",)]
    got = one(spark, "v string", rows, secrets.token(F.col("v"), "eml", salt))
    for (value,), made in zip(rows, got):
        mac = hmac.new(salt.encode(), (value or "").encode(), hashlib.sha256).hexdigest()
        assert made == (f"eml_{mac[:16]}" if value else "")
        assert not value or len(made) == 20


def test_tokens_normalise(spark):
    rows = [("  USER@EXAMPLE.COM  ", "+1 (555) 123-4567", " JOHN Doe\n", 7), ("user@example.com", "15551234567", "john doe", 7)]
    columns = [
        secrets.email_token(F.col("e"), "s"), secrets.phone_token(F.col("p"), "s"),
        secrets.name_token(F.col("n"), "s"), secrets.user_token(F.col("i"), "s"),
    ]
    first, second = values(spark, "e string, p string, n string, i long", rows, *columns)
    assert first == second
    assert [v[:4] for v in first] == ["eml_", "phn_", "nam_", "usr_"]
    assert one(spark, "p string", [("no digits",)], secrets.phone_token(F.col("p"), "s")) == [""]


def test_salts_matter_and_are_required(spark):
    a, b = (one(spark, "v string", [("x",)], secrets.token(F.col("v"), "t", s)) for s in ("one", "two"))
    assert a != b
    with pytest.raises(ValueError):
        secrets.token(F.col("v"), "t", "")
    assert one(spark, "v string", [("x",)], secrets.salted_sha256(F.col("v"), "salt")) == [
        hashlib.sha256(b"saltx").hexdigest()
    ]


def test_masks(spark):
    emails = ["john.doe@example.com", "a@b.com", "", "notanemail", "ab@c@d", "@x", None]
    assert one(spark, "v string", [(e,) for e in emails], secrets.mask_email(F.col("v"))) == [
        "j***@example.com", "a@b.com", "", "notanemail", "a***@c@d", "@x", None
    ]
    phones = ["+1-555-123-4567", "5551234567", "123", None]
    assert one(spark, "v string", [(p,) for p in phones], secrets.mask_phone(F.col("v"))) == [
        "***-***-4567", "***-***-4567", "****", None
    ]
    cards = ["4111111111111111", "4111-1111-1111-1111", "123"]
    assert one(spark, "v string", [(c,) for c in cards], secrets.mask_card(F.col("v"))) == [
        "****-****-****-1111", "****-****-****-1111", "****"
    ]


def test_features(spark):
    rows = [("user@shop.test", "+1-555-123-4567"), ("a@b@c", "+15551234567"), ("none", "0049"), (None, None)]
    got = values(spark, "e string, p string", rows, secrets.email_domain(F.col("e")), secrets.phone_country_code(F.col("p")))
    assert got == [("shop.test", "1"), ("b", "155"), (None, None), (None, None)]


def test_spans():
    as_of = datetime(2024, 3, 1, 10, 30, 5)
    assert time.day_before(as_of) == time.Span(datetime(2024, 2, 29), datetime(2024, 3, 1))
    assert time.hour_before(as_of) == time.Span(datetime(2024, 3, 1, 9), datetime(2024, 3, 1, 10))
    span = time.day_before(as_of)
    assert span.covers(span.start) and not span.covers(span.end)


@given(st.integers(0, 100), st.integers(1, 15))
def test_chunks_cover_the_span(length, days):
    start = datetime(2024, 1, 1)
    span = time.Span(start, start + time.timedelta(days=length))
    pieces = span.chunks(days)
    assert [p.start for p in pieces[1:]] == [p.end for p in pieces[:-1]]
    assert sum((p.length for p in pieces), time.timedelta()) == span.length
    assert all(p.length <= time.timedelta(days=days) for p in pieces)


def test_days(spark):
    moments = [datetime(2024, 1, 1, 23), datetime(2024, 1, 3, 1), datetime(2024, 1, 3, 12, 0, 0, 500000), None]
    as_of = datetime(2024, 1, 3, 12)
    got = values(
        spark, "t timestamp_ntz", [(m,) for m in moments],
        time.days_since(F.col("t"), as_of),
        time.whole_days(time.moment(as_of), F.col("t")),
        time.calendar_days(time.moment(as_of), F.col("t")),
    )
    # A moment after as_of: floored to -1, but cut to 0 as an interval.
    assert got == [((as_of - moments[0]).days, 1, 2), (0, 0, 0), (-1, 0, 0), (None, None, None)]


def test_chunk_numbers(spark):
    start = datetime(2024, 1, 1)
    rows = [(datetime(2024, 1, 1),), (datetime(2024, 1, 7, 23, 59, 59, 999999),), (datetime(2024, 1, 8),), (datetime(2023, 12, 31),)]
    assert one(spark, "t timestamp_ntz", rows, time.chunk_number(F.col("t"), start, 7)) == [0, 0, 1, -1]


def test_results_do_not_depend_on_the_session_zone(spark):
    # Clocks in this zone skip an hour on 10 March 2024.
    rows = [(datetime(2024, 3, 9, 12), datetime(2024, 3, 10, 12))]
    columns = [
        time.days_since(F.col("a"), datetime(2024, 3, 10, 12)), time.millis_between(F.col("a"), F.col("b")),
        time.whole_days(F.col("b"), F.col("a")), time.chunk_number(F.col("b"), datetime(2024, 3, 9, 12), 1),
        time.month(F.col("a")).cast("string"),
    ]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(spark, "a timestamp_ntz, b timestamp_ntz", rows, *columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(1, 86_400_000, 1, 1, "2024-03-01")]


def test_milliseconds_are_cut_towards_zero(spark):
    start = datetime(2024, 1, 1)
    ends = [datetime(2024, 1, 3, 4, 5, 6, 789_999), datetime(2023, 12, 31, 23, 59, 59, 999_500)]
    got = one(spark, "a timestamp_ntz, b timestamp_ntz", [(start, e) for e in ends], time.millis_between(F.col("a"), F.col("b")))
    assert got == [int((e - start).total_seconds() * 1000) for e in ends]
