"""Record, field and identity fingerprints as columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.text import folded, strip

# What joins the parts of a fingerprint, and how a NULL part is written.
SEPARATOR, NULL_TEXT = "|", "None"


def digest(value: Column, algorithm: str = "sha256") -> Column:
    if algorithm == "sha256":
        return F.sha2(value, 256)
    if algorithm == "md5":
        return F.md5(value)
    raise ValueError(f"unknown digest {algorithm!r}")


def _canonical(kind: T.DataType, value: Column) -> Column:
    """Structs with sorted field names, maps as sorted entries, at any depth; times, dates and decimals in their plain text form."""
    if isinstance(kind, T.StructType):
        inner = [_canonical(f.dataType, value.getField(f.name)).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _canonical(kind.elementType, x))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(
            _canonical(kind.keyType, e.getField("key")).alias("key"), _canonical(kind.valueType, e.getField("value")).alias("value"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType)):
        return value.cast("string")
    return value


def record_fingerprint(df: DataFrame, algorithm: str = "sha256", columns: Collection[str] | None = None) -> Column:
    """Digest of the row as JSON with sorted keys: equal rows have equal digests, whatever their column order."""
    names = sorted(columns if columns is not None else df.columns)
    parts = [_canonical(df.schema[n].dataType, F.col(f"`{n}`")).alias(n) for n in names]
    return digest(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), algorithm)


def _plain(kind: T.DataType, value: Column) -> Column:
    """A value as text: True and False with capitals, times with all six decimals or none."""
    if isinstance(kind, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _canonical(kind.elementType, x))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(
            _canonical(kind.keyType, e.getField("key")).alias("key"), _canonical(kind.valueType, e.getField("value")).alias("value"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        decimals = F.date_format(value, ".SSSSSS")
        return F.when(decimals == ".000000", whole).otherwise(F.concat(whole, decimals))
    return value.cast("string")


def field_fingerprint(df: DataFrame, fields: Collection[str], algorithm: str = "sha256") -> Column:
    """Digest of some fields, sorted by name; absent ones count as '', NULL has its own mark."""
    parts = [
        F.coalesce(_plain(df.schema[f].dataType, F.col(f)), F.lit(NULL_TEXT)) if f in df.columns else F.lit("")
        for f in sorted(fields)
    ]
    return digest(F.concat_ws(SEPARATOR, *parts), algorithm)


def identity_hash(email: Column, phone: Column, name: Column, algorithm: str = "sha256") -> Column:
    """Digest of a person's normalised contact data; NULL counts as ''."""
    def or_empty(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    parts = F.concat_ws(SEPARATOR, folded(or_empty(email)), strip(or_empty(phone)), folded(or_empty(name)))
    return digest(parts, algorithm)
