"""Privacy operators over whole tables. All are narrow: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import secrets as S
from tallyhouse.functions.text import has_text

REDACTED = "[REDACTED]"

# Columns redacted by default, in the current and the older rule set.
REDACT_COLUMNS = (
    "email", "phone", "ssn", "social_security_number", "credit_card", "card_number", "cvv", "cvc",
    "address", "street_address", "billing_address", "date_of_birth", "dob", "birth_date",
    "name", "first_name", "last_name", "full_name", "ip_address", "ip", "password", "password_hash",
)
REDACT_COLUMNS_V1 = ("email", "phone", "ssn", "credit_card", "address", "date_of_birth", "name", "ip_address")

# Columns that may be shown by default.
SAFE_COLUMNS = (
    "id", "user_token", "created_at", "updated_at", "status", "type", "category", "amount", "currency",
    "count", "total", "average", "percentage", "country_code", "region", "timezone",
)

# A field whose name contains one of these is sensitive.
SENSITIVE_PARTS = (
    "password", "secret", "token", "api_key", "apikey", "credit_card", "card_number", "cvv", "ssn",
    "email", "phone", "address",
)


def tokenize_columns(df: DataFrame, prefixes: dict[str, str], salt: str | bytes) -> DataFrame:
    """Replace each named column by a token with the given prefix."""
    return df.withColumns({c: S.token(F.col(c), prefix, salt) for c, prefix in prefixes.items()})


def tokenize_contacts(df: DataFrame, salt: str | bytes) -> DataFrame:
    """Contact columns become normalised tokens; ``id`` also gives a user token."""
    makers = {"email": S.email_token, "phone": S.phone_token, "name": S.name_token}
    tokens = {f"{c}_token": make(F.col(c), salt) for c, make in makers.items() if c in df.columns}
    if "id" in df.columns:
        tokens["user_token"] = S.user_token(F.col("id"), salt)
    return df.withColumns(tokens).drop(*makers)


def tokenize_payments(df: DataFrame, salt: str | bytes) -> DataFrame:
    """Card, holder and billing address become tokens (NULL where there was nothing); originals go."""
    present = {c: has_text(F.col(c)) for c in ("card_number", "billing_address", "cardholder_name") if c in df.columns}
    out: dict[str, Column] = {}

    def put(target: str, source: str, value: Column) -> None:
        out[target] = F.when(present[source], value)

    if "card_number" in present:
        # The raw text is the token's input: spaces and dashes make different tokens.
        put("card_token", "card_number", S.token(F.col("card_number"), S.CARD, salt))
        put("card_last_four", "card_number", S.last_four(F.col("card_number")))
    if "billing_address" in present:
        put("billing_token", "billing_address", S.token(F.col("billing_address"), S.ADDRESS, salt))
    if "cardholder_name" in present:
        # Not case-folded, unlike the name token of contacts.
        put("cardholder_token", "cardholder_name", S.token(F.col("cardholder_name"), S.NAME, salt))
    return df.withColumns(out).drop(*present)


def mask_payments(df: DataFrame) -> DataFrame:
    """The older treatment: a masked card for display; the raw columns go here as well."""
    card = F.col("card_number") if "card_number" in df.columns else F.lit(None).cast("string")
    shown = S.mask_card(F.coalesce(card, F.lit("")))
    return df.withColumn("card_display", shown).drop("card_number", "billing_address", "cardholder_name")


def mask_contacts(df: DataFrame) -> DataFrame:
    masks = {"email": S.mask_email, "phone": S.mask_phone, "card_number": S.mask_card}
    return df.withColumns({c: mask(F.col(c)) for c, mask in masks.items() if c in df.columns})


def hash_columns(df: DataFrame, columns: Collection[str]) -> DataFrame:
    """Add unsalted MD5 and SHA-1 of columns; kept for joins with older data sets."""
    out = {}
    for c in columns:
        out[f"{c}_md5"], out[f"{c}_sha1"] = F.md5(c), F.sha1(c)
    return df.withColumns(out)


def anonymize_users(df: DataFrame, drop_originals: bool = True) -> DataFrame:
    """Masks and MD5 digests of contact columns; the originals go unless asked for."""
    out: dict[str, Column] = {}
    for c, mask in {"email": S.mask_email, "phone": S.mask_phone, "name": None}.items():
        if c in df.columns:
            if mask is not None:
                out[f"{c}_masked"] = mask(F.col(c))
            out[f"{c}_hash"] = F.md5(c)
    done = df.withColumns(out)
    return done.drop("email", "phone", "name") if drop_originals else done


def _filled(df: DataFrame, name: str) -> Column:
    """True where a value is neither NULL, empty, zero nor false."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return has_text(value)
    if isinstance(kind, T.BooleanType):
        return F.coalesce(value, F.lit(False))
    if isinstance(kind, T.NumericType):
        return value.isNotNull() & (value != 0)
    return value.isNotNull()


def redact(df: DataFrame, columns: Collection[str] = REDACT_COLUMNS, replacement: str = REDACTED) -> DataFrame:
    """Replace filled values of the named columns; empty ones stay as they are."""
    return df.withColumns({
        c: F.when(_filled(df, c), F.lit(replacement)).otherwise(F.col(c).cast("string"))
        for c in df.columns if c in columns
    })


def redact_all(df: DataFrame, columns: Collection[str] = REDACT_COLUMNS_V1) -> DataFrame:
    """The older rule: every value of the named columns is replaced, also NULL and ''."""
    return df.withColumns({c: F.lit(REDACTED) for c in df.columns if c in columns})


def keep_safe(df: DataFrame, allowed: Collection[str] = SAFE_COLUMNS) -> DataFrame:
    """Only the columns on the list. The scan below never reads the others."""
    return df.select(*[c for c in df.columns if c in allowed])


def contact_features(df: DataFrame, keep: Collection[str] = ("id",)) -> DataFrame:
    """Email domain and phone country code, nothing else of the contact data."""
    return df.select(
        *[c for c in df.columns if c in keep],
        S.email_domain(F.col("email")).alias("email_domain"),
        S.phone_country_code(F.col("phone")).alias("phone_country_code"),
    )


def sanitize(df: DataFrame, parts: Collection[str] = SENSITIVE_PARTS) -> DataFrame:
    """Redact every field and map key, at any depth of structs, maps and arrays, whose name contains a sensitive part.

    A map has values of one type: where that is not text, a redacted value is NULL.
    """

    def sensitive(name: Column) -> Column:
        found = F.lit(False)
        for part in parts:
            found = found | F.lower(name.cast("string")).contains(part)
        return found

    def inside(kind: T.DataType, value: Column) -> Column:
        if isinstance(kind, T.StructType):
            return F.when(value.isNotNull(), F.struct(*clean(kind, value)))
        if isinstance(kind, T.ArrayType) and _nested(kind.elementType):
            return F.transform(value, lambda x: inside(kind.elementType, x))
        if isinstance(kind, T.MapType):
            mark = F.lit(REDACTED) if isinstance(kind.valueType, T.StringType) else F.lit(None)
            return F.transform_values(value, lambda k, v: F.when(sensitive(k), mark).otherwise(inside(kind.valueType, v)))
        return value

    def clean(schema: T.StructType, at: Column | None) -> list[Column]:
        out = []
        for field in schema:
            value = F.col(f"`{field.name}`") if at is None else at.getField(field.name)
            if any(part in field.name.lower() for part in parts):
                value = F.lit(REDACTED)
            else:
                value = inside(field.dataType, value)
            out.append(value.alias(field.name))
        return out

    return df.select(*clean(df.schema, None))


def _nested(kind: T.DataType) -> bool:
    """Whether values of a type can hold names."""
    return isinstance(kind, (T.StructType, T.MapType)) or isinstance(kind, T.ArrayType) and _nested(kind.elementType)
