"""Digests, keyed tokens and masks for personal data.

Every function is a native expression. HMAC is two nested ``sha2`` calls whose padded
keys are computed once on the driver, so no row leaves the JVM.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.text import digits_only, folded

# Block size and pad bytes of HMAC-SHA256.
_BLOCK = 64
_INNER, _OUTER = 0x36, 0x5C

# Token prefixes and their number of hex digits.
EMAIL, PHONE, NAME, USER, CARD, ADDRESS = "eml", "phn", "nam", "usr", "crd", "adr"
TOKEN_DIGITS = 16


def _salt_bytes(salt: str | bytes) -> bytes:
    raw = salt.encode() if isinstance(salt, str) else bytes(salt)
    if not raw:
        raise ValueError("a salt is required: without it tokens could be recomputed by anyone")
    return raw


def hmac_pads(salt: str | bytes) -> tuple[bytes, bytes]:
    """Inner and outer key block of HMAC-SHA256."""
    key = _salt_bytes(salt)
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ _INNER for b in key), bytes(b ^ _OUTER for b in key)


def hmac_sha256(value: Column, salt: str | bytes) -> Column:
    """Hex HMAC-SHA256 of the UTF-8 text."""
    inner, outer = hmac_pads(salt)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), value.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def token(value: Column, prefix: str, salt: str | bytes) -> Column:
    """``prefix_`` and the first hex digits of the HMAC; empty or NULL gives ''."""
    made = F.concat(F.lit(prefix + "_"), F.substring(hmac_sha256(value, salt), 1, TOKEN_DIGITS))
    # In this form the result is known not to be NULL, so a NULL check on it costs no second HMAC.
    return F.when(value == "", F.lit("")).otherwise(F.coalesce(made, F.lit("")))


def email_token(value: Column, salt: str | bytes) -> Column:
    return token(folded(value), EMAIL, salt)


def phone_token(value: Column, salt: str | bytes) -> Column:
    return token(digits_only(value), PHONE, salt)


def name_token(value: Column, salt: str | bytes) -> Column:
    return token(folded(value), NAME, salt)


def user_token(user_id: Column, salt: str | bytes) -> Column:
    return token(user_id.cast("string"), USER, salt)


def salted_sha256(value: Column, salt: str | bytes) -> Column:
    return F.sha2(F.concat(F.lit(_salt_bytes(salt)), value.cast("binary")), 256)


def mask_email(value: Column) -> Column:
    """First character and domain stay; one-character names and other text are left alone."""
    return F.regexp_replace(value, r"^([^@])[^@]+@", "$1***@")


def last_four(value: Column) -> Column:
    """The last four digits, or ``****`` when there are fewer."""
    digits = digits_only(value)
    return F.when(F.char_length(digits) < 4, F.lit("****")).otherwise(F.right(digits, F.lit(4)))


def _masked_digits(value: Column, cover: str) -> Column:
    digits = digits_only(value)
    return F.when(F.char_length(digits) < 4, F.lit("****")).otherwise(
        F.concat(F.lit(cover), F.right(digits, F.lit(4)))
    )


def mask_phone(value: Column) -> Column:
    return _masked_digits(value, "***-***-")


def mask_card(value: Column) -> Column:
    return _masked_digits(value, "****-****-****-")


def email_domain(value: Column) -> Column:
    """Text between the first and the second ``@``; NULL without one."""
    return F.when(value.contains("@"), F.split_part(value, F.lit("@"), F.lit(2)))


def phone_country_code(value: Column) -> Column:
    """Up to three digits right after a leading plus sign; NULL otherwise."""
    return F.nullif(F.regexp_extract(value, r"^\+(\p{Nd}{1,3})", 1), F.lit(""))
