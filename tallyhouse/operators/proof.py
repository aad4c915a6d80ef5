"""Proof of a load: which keys of a table are absent, left over or changed, found by digests before any row is joined.

Every range of a table (a month, say) has a digest of its rows that doesn't depend on their order. Digests of ranges add up to
digests of wider ones, so two tables are compared from the top: equal wide ranges are done with, and rows are read, and
joined by key, only in the narrow ranges that differ. Digests are stored beside a table by the one who writes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.merge import replace_partitions
from tallyhouse.operators.staging import settled

#: What adds up: rows, two bitwise differences of hashes of rows, and a sum of parts of one, as equal rows cancel in a difference.
MARKS = ("n", "left", "right", "total")
ABSENT, EXTRA, CHANGED = "absent", "extra", "changed"


def _hash(rows: DataFrame, ranges: Sequence[str], seed: int) -> Column:
    """A hash of all columns but the ranges, by name and in their text form: integers of different width agree."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in sorted(rows.columns) if c not in ranges]
    return F.xxhash64(F.lit(seed), *values)


def digests(rows: DataFrame, ranges: Sequence[str]) -> DataFrame:
    """``ranges`` and the marks of each range, of columns of text, numbers and dates."""
    hashed = rows.select(*ranges, _hash(rows, ranges, 1).alias("one"), _hash(rows, ranges, 2).alias("two"))
    return hashed.groupBy(*ranges).agg(
        F.count("*").alias("n"), F.bit_xor("one").alias("left"), F.bit_xor("two").alias("right"),
        F.sum(F.pmod("one", F.lit(1 << 31))).alias("total"))


def wider(marks: DataFrame, ranges: Sequence[str]) -> DataFrame:
    """Digests of wider ranges from those of narrower ones."""
    return marks.groupBy(*ranges).agg(
        F.sum("n").alias("n"), F.bit_xor("left").alias("left"), F.bit_xor("right").alias("right"), F.sum("total").alias("total"))


def store_digests(rows: DataFrame, path: str, ranges: Sequence[str], partition: str) -> None:
    """Store the digests of rows that have just replaced their partitions of a table, beside it."""
    replace_partitions(digests(rows, ranges), f"{path}_digests", partition)


def differing(mine: DataFrame, theirs: DataFrame, ranges: Sequence[str]) -> DataFrame:
    """The narrowest ranges whose digests differ, from the widest (all rows) on. ``ranges`` go from wide to narrow."""
    mine = settled(mine, "digests")
    if wider(mine, []).first() == wider(theirs, []).first():  # one row each: all is equal
        return mine.select(*ranges).limit(0)
    found: DataFrame | None = None
    for depth in range(1, len(ranges) + 1):
        at = list(ranges[:depth])
        sides = [wider(m if found is None else m.join(found, at[:-1], "left_semi"), at).select(*at, F.struct(*MARKS).alias(name))
                 for m, name in ((mine, "_mine"), (theirs, "_theirs"))]
        apart = sides[0].join(sides[1], at, "full").where(~F.col("_mine").eqNullSafe(F.col("_theirs")))
        found = settled(apart.select(*at), "differing")
    return found


def load_differences(
    new: DataFrame, table: DataFrame, stored: DataFrame, key: Sequence[str], ranges: Sequence[str], partition: str
) -> DataFrame:
    """``key`` and ``state`` of rows that a table should have and hasn't, has and shouldn't, or has with other values.

    ``stored`` are the table's digests, ``partition`` is the range its files are partitioned by. Of the table itself only the
    partitions that differ are read. Keys are unique and have no NULL in them.
    """
    found = differing(digests(new, ranges), stored, ranges)
    # The ranges of a calendar: a short row for each.
    parts = sorted(r[0] for r in found.select(partition).distinct().collect())
    sides = []
    for rows, name in ((new, "_new"), (table, "_old")):
        rows = rows.where(F.col(partition).isin(parts)).join(found, list(ranges), "left_semi")
        values = [c for c in sorted(rows.columns) if c not in key and c not in ranges]
        sides.append(rows.select(*key, F.struct(F.lit(1), *(F.col(c).cast("string") for c in values)).alias(name)))
    both = sides[0].join(sides[1], list(key), "full")
    state = F.when(F.col("_old").isNull(), ABSENT).when(F.col("_new").isNull(), EXTRA).otherwise(CHANGED)
    return both.where(~F.col("_new").eqNullSafe(F.col("_old"))).select(*key, state.alias("state"))
