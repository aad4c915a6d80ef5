"""Duplicates: removing, marking, and listing them.

A fingerprint may be shared by a large part of all rows. So nothing here sorts or gathers
the rows of one fingerprint in one task: what is known about fingerprints comes from
aggregates that combine on the map side, and meets the rows in a join that is broadcast or
that AQE can cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.load import append_if_absent, existing
from tallyhouse.operators.staging import settled

FINGERPRINT = "fingerprint"


def distinct_records(df: DataFrame) -> DataFrame:
    """One of each set of equal rows.

    Equal rows have equal record fingerprints and the reverse, so Spark's own hash aggregate
    over the columns gives the same rows without computing a digest.
    """
    return df.distinct()


def stamped(df: DataFrame, fingerprint: Column) -> DataFrame:
    """Add the fingerprint. It is never NULL, so rows without one count as equal, and the NULL
    checks of later joins are dropped instead of computing the digest twice."""
    return df.withColumn(FINGERPRINT, F.coalesce(fingerprint, F.lit("")))


def _verdicts(marked: DataFrame, row_id: str, seen: DataFrame | None) -> DataFrame:
    """The fingerprints that decide anything: repeated ones with their first row, and known ones.

    Only fingerprint and id are aggregated, one row per fingerprint meets the known ones, and
    what is left is settled, since it is usually far smaller than the records.
    """
    found = marked.groupBy(FINGERPRINT).agg(F.min(row_id).alias("_first"), F.count("*").alias("_n"))
    if seen is None:
        found = found.withColumn("_known", F.lit(False))
    else:
        known = seen.select(FINGERPRINT).distinct().withColumn("_known", F.lit(True))
        found = found.join(known, FINGERPRINT, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    deciding = found.filter((F.col("_n") > 1) | F.col("_known"))
    return settled(deciding.select(FINGERPRINT, "_first", "_known"), "verdicts")


def pairs(df: DataFrame, fingerprint: Column, row_id: str) -> DataFrame:
    """``row_id`` and fingerprint of every row, settled: the records are read and hashed once."""
    return settled(stamped(df, fingerprint).select(row_id, FINGERPRINT), "pairs")


def mark_new(df: DataFrame, fingerprint: Column, row_id: str, seen: DataFrame | None = None) -> DataFrame:
    """Id, fingerprint and ``is_new`` of every row: first of its kind and not known before.

    ``row_id`` is a stored column that orders the rows and differs between them (without one,
    use ``firsts.first_per_key``). Only the narrow pairs are aggregated and joined. While the table of verdicts
    is small enough to broadcast they are not shuffled again. When it is not, both sides of the
    join come straight from their shuffles and nothing
    here needs its partitioning, which is what lets AQE cut the partition of a hot fingerprint.
    """
    marked = pairs(df, fingerprint, row_id)
    joined = marked.join(_verdicts(marked, row_id, seen), FINGERPRINT, "left")
    new = F.col("_known").isNull() | (~F.col("_known") & (F.col(row_id) == F.col("_first")))
    return joined.select(row_id, FINGERPRINT, F.coalesce(new, F.lit(False)).alias("is_new"))


def new_records(df: DataFrame, fingerprint: Column, row_id: str, seen: DataFrame | None = None) -> DataFrame:
    """First occurrences that are not in the table of known fingerprints, with all their columns.

    The records come in at the end, by id; a plan that needs none of their wide columns never reads them again.
    """
    new = mark_new(df, fingerprint, row_id, seen).filter("is_new").select(row_id, FINGERPRINT)
    return df.join(new, row_id).select(*df.columns, FINGERPRINT)


def first_per_fingerprint(df: DataFrame, fingerprint: Column, row_id: str) -> DataFrame:
    """First occurrence per fingerprint, with the fingerprint as a column."""
    return new_records(df, fingerprint, row_id)


def known_records(df: DataFrame, fingerprint: Column, seen: DataFrame) -> DataFrame:
    """Rows whose fingerprint is in the table of known ones. ``df`` should be narrow, or its pairs.

    The known ones are narrowed to those the rows really have, and settled, before they meet the rows.
    """
    marked = stamped(df, fingerprint)
    present = marked.select(FINGERPRINT).distinct().join(seen.select(FINGERPRINT), FINGERPRINT, "left_semi")
    return marked.join(settled(present, "known"), FINGERPRINT, "left_semi")


def fingerprint_table(df: DataFrame, fingerprint: Column) -> DataFrame:
    """The distinct fingerprints of a frame: what a later batch checks against."""
    return stamped(df, fingerprint).select(FINGERPRINT).distinct()


def remember(df: DataFrame, fingerprint: Column, path: str) -> int:
    """Add a batch's fingerprints to the stored table of known ones; gives the number of new ones.

    Call it after the batch itself has been loaded: if a run breaks in between, the batch is
    taken as new again, and insert-if-absent loading leaves out what is already there.
    """
    return append_if_absent(fingerprint_table(df, fingerprint), path, [FINGERPRINT])


def recall(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table of known fingerprints, or None before the first batch; its count is the number seen."""
    return existing(spark, path)


def forget(spark: SparkSession, path: str) -> None:
    """Empty the stored table."""
    spark.createDataFrame([], f"{FINGERPRINT} string").write.mode("overwrite").parquet(path)


def duplicate_members(df: DataFrame, key: Column, member: str, name: str) -> DataFrame:
    """A row for each member of a key held by more than one row, with the size of its group.

    Rows with a NULL key are left out. The shape is the same for any size of a group. The sizes of repeated
    keys are settled first, so only members of such groups are shuffled when that table can be broadcast.
    """
    keyed = settled(df.select(key.alias(name), F.col(member).alias("duplicate_id")).filter(F.col(name).isNotNull()), "keys")
    sizes = keyed.groupBy(name).agg(F.count("*").alias("duplicate_count")).filter(F.col("duplicate_count") > 1)
    return keyed.join(settled(sizes, "sizes"), name).select(name, "duplicate_count", "duplicate_id")


def listed(members: DataFrame, name: str, joined_by: str | None = None) -> DataFrame:
    """The members of each group as one sorted list, or text: a choice of the reader who knows that groups are small."""
    ids = F.array_sort(F.collect_list("duplicate_id"))
    if joined_by is not None:
        ids = F.array_join(F.transform(ids, lambda m: m.cast("string")), joined_by)
    return members.groupBy(name, "duplicate_count").agg(ids.alias("duplicate_ids"))
