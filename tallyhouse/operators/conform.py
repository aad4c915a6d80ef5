"""Bring rows into an entity schema, split off the ones that do not fit, and publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.secrets import email_token, name_token, phone_token
from tallyhouse.operators.schemas import DECIMAL, Field, fields_of

REASONS = "reject_reasons"


class Conformed(NamedTuple):
    """Rows that fit the schema, and the others with their reasons and original text values."""

    valid: DataFrame
    rejected: DataFrame


def value_or(df: DataFrame, name: str, default: Column) -> Column:
    """A column with a default for NULL, or the default alone when the column does not exist."""
    return F.coalesce(F.col(name), default) if name in df.columns else default


def decimal_text(df: DataFrame, name: str) -> Column:
    """A number as exact text: '0' for a missing column, NULL for NULL or unreadable values."""
    if name not in df.columns:
        return F.lit("0")
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(value.try_cast("decimal(38,10)").isNotNull(), F.trim(value))
    return value.cast("string")


def _typed(df: DataFrame, field: Field) -> Column:
    """The given value in the field's type; NULL where it cannot be cast."""
    same = df.schema[field.name].dataType.simpleString() == field.kind
    return F.col(field.name) if same else F.col(field.name).try_cast(field.kind)


def _filled(df: DataFrame, field: Field) -> Column:
    """The typed value, with the default where nothing was given."""
    default = F.lit(field.default).cast(field.kind)
    if field.name not in df.columns:
        return default
    typed = _typed(df, field)
    return typed if field.default is None else F.when(F.col(field.name).isNull(), default).otherwise(typed)


def _rules(df: DataFrame, field: Field) -> list[tuple[Column, str]]:
    """Conditions a row has to meet (never NULL), each with the reason for not meeting it."""
    if field.name not in df.columns:
        return [(F.lit(False), f"{field.name}: required")] if field.required else []
    given, rules = F.col(field.name), []
    if field.required:
        rules.append((given.isNotNull(), f"{field.name}: required"))
    if df.schema[field.name].dataType.simpleString() != field.kind:
        rules.append((given.isNull() | _typed(df, field).isNotNull(), f"{field.name}: not a {field.kind}"))
    if field.allowed:
        rules.append((given.isNull() | _typed(df, field).isin(*field.allowed), f"{field.name}: unknown value"))
    return rules


def conform(df: DataFrame, entity: str, version: int) -> Conformed:
    """Cast, fill defaults, and split rows by whether they fit. Narrow plans over one scan.

    The valid side filters by the single conditions, so those on plain columns are pushed
    into the scan; only the rejected side builds the list of reasons.
    """
    fields = fields_of(entity, version)
    rules = [rule for f in fields for rule in _rules(df, f)]
    fits = reduce(lambda a, b: a & b, [ok for ok, _ in rules], F.lit(True))
    reasons = F.array_compact(F.array(*[F.when(~ok, F.lit(why)) for ok, why in rules]))
    columns = [_filled(df, f).alias(f.name) for f in fields]
    return Conformed(df.filter(fits).select(*columns), df.filter(~fits).select(*columns, reasons.alias(REASONS)))


def publish(df: DataFrame, entity: str, version: int, salt: str | bytes | None = None) -> DataFrame:
    """The published columns in order: version 2 money as text, version 1 contact data as tokens."""
    contact = {"email": email_token, "phone": phone_token, "name": name_token}

    def shown(field: Field) -> Column:
        value = F.col(field.name)
        if field.kind == DECIMAL:
            return value.cast("string").alias(field.name)
        if version == 1 and entity == "user" and field.name in contact:
            if salt is None:
                raise ValueError("publishing users of version 1 needs a token salt")
            return contact[field.name](value, salt).alias(f"{field.name}_token")
        return value

    return df.select(*[shown(f) for f in fields_of(entity, version) if f.publish])


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as plain columns whose names join the path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out.extend(leaves(field.dataType, here))
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def missing_fields(df: DataFrame, required: Sequence[str]) -> Column:
    """Names of required fields that are absent or NULL in a row."""
    absent = [F.lit(f) for f in required if f not in df.columns]
    empty = [F.when(F.col(f).isNull(), F.lit(f)) for f in required if f in df.columns]
    return F.array_compact(F.array(*absent, *empty)) if required else F.array().cast("array<string>")


def is_complete(df: DataFrame, required: Sequence[str]) -> Column:
    """True where every required field is present."""
    if any(f not in df.columns for f in required):
        return F.lit(False)
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in required], F.lit(True))


def completeness_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required field the rows that pass and fail, and for all fields together, in one pass."""
    tests: Mapping[str, Column] = {f: is_complete(df, [f]) for f in required}
    labels = [*tests, "(all)"]
    checks = [*tests.values(), is_complete(df, required)]
    counted = df.agg(
        F.count("*").alias("rows"), *[F.count_if(c).alias(f"passed_{i}") for i, c in enumerate(checks)]
    )
    entries = F.array(*[
        F.struct(F.lit(label).alias("field"), F.col(f"passed_{i}").alias("passed"),
                 (F.col("rows") - F.col(f"passed_{i}")).alias("failed"))
        for i, label in enumerate(labels)
    ])
    return counted.select(F.inline(entries))
