"""Substring search by an index of trigrams, in place of a scan of all texts.

For every three letters that follow each other in an indexed column, words of 64 bits hold the rows that have them, one bit
an id. The words of all trigrams of a term are intersected, which leaves the rows that may hold it; these are read from
their blocks of ids, and compared with the term itself. A term of fewer letters has no trigram and is scanned for.

Rows have some dozen trigrams each and may come in a few partitions, so they are dealt out by words of ids before their
trigrams are listed: a task indexes about TASK_CHARS characters, however large the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.merge import replace_partitions
from tallyhouse.operators.staging import settled

GRAM = 3
PART, BLOCK, WORD = "part", "block", "word"
WORD_BITS = 6
TASK_CHARS = 1 << 22


@dataclass(frozen=True)
class TextIndex:
    """A folder, the columns it was built for, ids in a block of rows, and partitions of trigrams."""

    path: str
    columns: tuple[str, ...]
    row_id: str = "id"
    block: int = 1 << 18
    parts: int = 32


def grams(text: Column) -> Column:
    """The different trigrams of a text."""
    last = F.length(text) - (GRAM - 1)
    found = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(found))


def _part(gram: Column, index: TextIndex) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(index.parts)).cast("int")


def _word(row_id: Column) -> Column:
    return F.shiftright(row_id, WORD_BITS)


def _bit(row_id: Column) -> Column:
    """The bit of an id in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), row_id.bitwiseAND((1 << WORD_BITS) - 1).cast("int"))


def postings(rows: DataFrame, index: TextIndex) -> DataFrame:
    """``gram, word, bits``: the rows that have a trigram, a row for each word of ids in which there are any."""
    texts = [F.col(c) for c in index.columns]
    chars = rows.select(F.sum(sum((F.coalesce(F.length(t), F.lit(0)).cast("long") for t in texts), F.lit(0)))).first()[0] or 0
    row_id = F.col(index.row_id).cast("long")
    dealt = rows.select(_word(row_id).alias(WORD), _bit(row_id).alias("bit"), *texts).repartition(1 + chars // TASK_CHARS, WORD)
    none = F.array().cast("array<string>")
    listed = F.array_distinct(F.concat(*(F.coalesce(grams(t), none) for t in texts)))
    return dealt.select(WORD, "bit", F.explode(listed).alias("gram")).groupBy("gram", WORD).agg(F.bit_or("bit").alias("bits"))


def build_index(rows: DataFrame, index: TextIndex) -> None:
    """Write rows by blocks of ids, and the words of their trigrams."""
    blocked = rows.withColumn(BLOCK, F.floor(F.col(index.row_id) / index.block))
    replace_partitions(blocked, f"{index.path}/rows", BLOCK)
    # From the rows as written: what they are derived from isn't computed again.
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{index.path}/rows")
    replace_partitions(postings(stored, index).withColumn(PART, _part(F.col("gram"), index)), f"{index.path}/grams", PART)


def _found(spark: SparkSession, index: TextIndex, term: str) -> DataFrame:
    """``word, bits``: the rows that have all trigrams of a term."""
    wanted = sorted({term[i : i + GRAM] for i in range(len(term) - GRAM + 1)})
    parts = [r[0] for r in spark.createDataFrame([(g,) for g in wanted], "gram string").select(_part(F.col("gram"), index)).distinct().collect()]
    stored = spark.read.schema(f"gram string, {WORD} long, bits long, {PART} int").parquet(f"{index.path}/grams")
    found = stored.where(F.col(PART).isin(parts) & F.col("gram").isin(wanted)).groupBy(WORD).agg(
        F.count("*").alias("n"), F.bit_and("bits").alias("bits"))
    return found.where((F.col("n") == len(wanted)) & (F.col("bits") != 0)).select(WORD, "bits")


def candidates(spark: SparkSession, index: TextIndex, term: str, schema: str) -> DataFrame:
    """The rows that may hold a term; only their blocks are read. ``schema`` is that of the rows."""
    rows = spark.read.schema(f"{schema}, {BLOCK} long").parquet(f"{index.path}/rows")
    if len(term) < GRAM:
        return rows.drop(BLOCK)
    found = settled(_found(spark, index, term), "candidates")
    # Words are few for a rare term; there are few blocks in all.
    low = F.col(WORD) * (1 << WORD_BITS)
    blocks = F.explode(F.sequence(F.floor(low / index.block), F.floor((low + (1 << WORD_BITS) - 1) / index.block)))
    wanted = [r[0] for r in found.select(blocks.alias(BLOCK)).distinct().collect()]
    row_id = F.col(index.row_id).cast("long")
    near = rows.where(F.col(BLOCK).isin(wanted)).withColumn(WORD, _word(row_id)).join(found, WORD)
    return near.where(F.col("bits").bitwiseAND(_bit(row_id)) != 0).drop(WORD, "bits", BLOCK)


def search(spark: SparkSession, index: TextIndex, term: str, schema: str, limit: int) -> DataFrame:
    """The first rows by id of which a column contains the term, taken literally."""
    holds = F.lit(False)
    for c in index.columns:
        holds = holds | F.coalesce(F.contains(F.col(c), F.lit(term)), F.lit(False))
    return candidates(spark, index, term, schema).where(holds).orderBy(index.row_id).limit(limit)
