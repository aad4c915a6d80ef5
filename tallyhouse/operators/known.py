"""A store of known fingerprints that a batch reads in part only.

Fingerprints are dealt to partitions by a hash, within these to the batches that brought them. Beside them lies a
Bloom filter for each partition, as bitmaps of 4 KB, which is about a thirtieth of the fingerprints' size. A batch first asks the
filters of its own partitions; only what they may hold is looked up exactly, in the partitions where anything may be. So a batch of
new records reads hardly more than filters, and one of few records few partitions. A filter can be too full, as its
size is fixed for the life of a store: more is looked up then, and results stay exact.

Writing is by batch and can be repeated: a replayed batch replaces its own part, and sets bits that are set. One writer at a time.
"""

from __future__ import annotations

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import FINGERPRINT
from tallyhouse.operators.load import existing
from tallyhouse.operators.merge import replace_partitions
from tallyhouse.operators.staging import settled

#: Bits set for a fingerprint.
HASHES = 4
#: Bits of one bitmap, fixed by Spark's bitmap functions.
BITMAP_BITS = 32_768
PART, BATCH, BUCKET, BITS = "part", "batch", "bucket", "bits"


@dataclass(frozen=True)
class Store:
    """A folder, its partitions, and the bits of each one's filter; both are fixed for the life of the store.

    With the given numbers filters are good for some 13 million fingerprints; see ``sized``.
    """

    path: str
    parts: int = 8
    filter_bits: int = 1 << 24

    @classmethod
    def sized(cls, path: str, expected: int, parts: int = 256) -> Store:
        """A store for about so many fingerprints, with ten bits for each. More partitions let small batches read less."""
        return cls(path, parts, -(-10 * expected // parts))

    def part(self) -> Column:
        return F.pmod(F.xxhash64(FINGERPRINT), F.lit(self.parts)).cast("int").alias(PART)

    def places(self) -> Column:
        """The bits of a fingerprint, from 1 on. Each hash is its own, so they differ from the one that deals out partitions."""
        places = [F.pmod(F.xxhash64(FINGERPRINT, F.lit(i)), F.lit(self.filter_bits)) + 1 for i in range(HASHES)]
        return F.explode(F.array(*places)).alias("place")


#: The two tables of a store.
PRINTS = f"{FINGERPRINT} string, {PART} int, {BATCH} int"
FILTERS = f"{BUCKET} long, {BITS} binary, {PART} int"


def _own(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The partitions of a table that rows lie in; others are not opened. Their numbers are no more than a store has."""
    return table.where(F.col(PART).isin([r[0] for r in rows.select(PART).distinct().collect()]))


def remember(prints: DataFrame, store: Store, batch: int) -> None:
    """Store the fingerprints of a batch and set their bits."""
    spark, new = prints.sparkSession, settled(prints.select(FINGERPRINT, store.part()).distinct(), "known-new")
    bits = new.select(PART, store.places()).groupBy(PART, F.bitmap_bucket_number("place").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias(BITS))
    before = existing(spark, f"{store.path}/filters", FILTERS)
    if before is not None:
        bits = _own(before, new).select(*bits.columns).unionByName(bits).groupBy(PART, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
        bits = settled(bits, "known-filters")  # what is read is replaced
    # The filters go first: a bit without its fingerprint does no harm, a fingerprint without its bits would not be found.
    replace_partitions(bits, f"{store.path}/filters", PART)
    replace_partitions(new.withColumn(BATCH, F.lit(batch)), f"{store.path}/prints", PART, BATCH)


def maybe_known(prints: DataFrame, store: Store) -> DataFrame | None:
    """``fingerprint, part`` of those whose bits are all set, settled; None for an empty store."""
    filters = existing(prints.sparkSession, f"{store.path}/filters", FILTERS)
    if filters is None:
        return None
    asked = settled(prints.select(FINGERPRINT, store.part()).distinct(), "known-asked")
    filters = _own(filters, asked)
    places = asked.select(FINGERPRINT, PART, store.places()).withColumns({
        BUCKET: F.bitmap_bucket_number("place"), "bit": F.bitmap_bit_position("place")})
    byte = F.conv(F.hex(F.substring(BITS, (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1") == 1
    found = places.join(filters, [PART, BUCKET]).withColumn("byte", byte).where(is_set).groupBy(FINGERPRINT, PART).agg(F.count("*").alias("n"))
    return settled(found.where(F.col("n") == HASHES).drop("n"), "known-maybe")


def known(prints: DataFrame, store: Store, before: int | None = None) -> DataFrame:
    """Those of the fingerprints that the store holds, from batches before the given one."""
    nothing = prints.select(FINGERPRINT).limit(0)
    maybe = maybe_known(prints, store)
    if maybe is None:
        return nothing
    stored = existing(prints.sparkSession, f"{store.path}/prints", PRINTS)
    if stored is None:
        return nothing
    stored = _own(stored, maybe)
    if before is not None:
        stored = stored.where(F.col(BATCH) < before)
    return maybe.join(stored.select(PART, FINGERPRINT), [PART, FINGERPRINT], "left_semi").select(FINGERPRINT)
