"""Quality rules: a ledger with every measurement and one failure bit per rule for each document.

Each rule is evaluated once. A policy is a versioned set of rules, that is a bit mask, so verdicts of
any policy, and what a policy would keep without one of its rules, come from the stored bits alone.

Defined results: a null or empty text has no words and fails ``few_words``; ids may be null or
repeated, each row is judged by itself; further columns are kept by `apply_policy` and dropped by
`ledger`; an empty table gives an empty ledger. Texts are measured whole, in slices of bounded
memory (a longer text is its own slice).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.words import WHITE, slices, windows, repeated

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEW_LINE = 10

MEASURES = "n_words word_chars n_symbols n_upper n_letters n_lines n_dup_lines n_repeat_words".split()

#: Rule name -> condition under which a document fails. The order fixes the bits: only append.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "shouting": "n_letters >= 20 and 2 * n_upper > n_letters",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines",
    "no_letters": "n_words > 0 and n_letters = 0",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}

#: Version -> rules that reject. A version never changes; a new one is added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "shouting"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(BIT[rule] for rule in POLICIES[policy])


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column and the measurements of its field ``text``, or of the second column."""
    for batch in batches:
        column = batch.column(1) if batch.num_columns > 1 else batch.column(0).field("text")
        parts = [measured(texts) for _, texts in slices(column)]
        found = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(x, pa.int64()) for x in found], names=[batch.schema.names[0], *MEASURES])


def measured(texts) -> list[np.ndarray]:
    """The arrays named in MEASURES."""
    data = texts.data
    inside = ~WHITE[data]
    starts, ends = texts.runs(inside)
    owner = texts.owner(starts)
    count = lambda owners: np.bincount(owners, minlength=texts.n).astype(np.int64)
    word = texts.fingerprints(starts, ends)
    # Fingerprints of windows and lines are salted with the text's number: equal only within a text.
    at, window = windows(word, owner, 5)
    twice, _ = repeated(window ^ (owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 5, -1)
    in_repeat = np.cumsum(cover[:-1]) > 0
    line_starts, line_ends = texts.runs(data != NEW_LINE)
    sums = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    with_word = sums[line_ends] > sums[line_starts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_owner = texts.owner(line_starts)
    line = texts.fingerprints(line_starts, line_ends) ^ (line_owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    upper = (data >= 65) & (data <= 90)
    return [
        count(owner),
        texts.per_text(inside & ((data & 0xC0) != 0x80)),
        texts.per_text(SYMBOLS[data]),
        texts.per_text(upper),
        texts.per_text(upper | (data >= 97) & (data <= 122) | (data >= 0xC3)),
        count(line_owner),
        count(line_owner[repeated(line)[1]]),
        count(owner[in_repeat]),
    ]


def fail_bits() -> Column:
    """The bits of all rules that the measurements of a row break."""
    return sum((F.when(F.expr(rule), BIT[name]).otherwise(0) for name, rule in RULES.items()), F.lit(0)).cast("long")


def ledger(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, the measurements and ``fail_bits`` of each document."""
    fields = ", ".join(f"{m} long" for m in MEASURES)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), "text").mapInArrow(measure, f"key {kind}, {fields}")
    return rows.select(F.col("key").alias(key), *MEASURES, fail_bits().alias("fail_bits"))


def verdict(policy: str = CURRENT) -> Column:
    """Whether the policy keeps a row of the ledger."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents the policy keeps, with their columns. Every row is judged in place by its bits, without a join."""
    held = docs.select(F.struct(*(F.col(f"`{n}`") for n in docs.columns)).alias("row"))
    rows = held.mapInArrow(measure, T.StructType([held.schema["row"]] + [T.StructField(m, T.LongType()) for m in MEASURES]))
    return rows.withColumn("fail_bits", fail_bits()).where(verdict(policy)).select("row.*")


def patterns(rows: DataFrame) -> DataFrame:
    """``fail_bits, n``: all that policies and ablations need; at most one row for each set of rules."""
    return rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """``rule, rejected, alone``: what the policy rejects by each rule, and what only that rule rejects.

    ``alone`` is what would come back if the rule were taken out of the policy.
    """
    whole = mask(policy)
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in POLICIES[policy])))
    hit = patterns(rows).select("fail_bits", "n", rules.alias("r")).select("fail_bits", "n", "r.*")
    failed = F.col("fail_bits").bitwiseAND(F.lit(whole))
    total = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    return hit.groupBy("rule").agg(
        total(failed.bitwiseAND(F.col("bit")) != 0).alias("rejected"), total(failed == F.col("bit")).alias("alone"))
