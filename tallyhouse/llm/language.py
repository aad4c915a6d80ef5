"""Language by Bayesian fusion: the text, a declared language, an address suffix and the host.

* Text: log-likelihoods under byte-trigram models, one per language, each trained on a documented, bounded
  sample of its labelled rows. All trigrams of the whole text count; the sum is scaled to the
  weight of ``EVIDENCE`` of them, as neighbouring trigrams are not independent.
* Declared language and suffix: how often each value goes with each language, counted over all rows by the
  language the text alone suggests, smoothed by one row of each language.
* Host prior: counts over all rows, smoothed towards the parent domain, that one towards its parent, and so on
  to the whole corpus: ``(count + STRENGTH * parent's share) / (rows + STRENGTH)``.

The unknown language is a class too: all trigrams equally likely. It wins where no model fits.

Defined results: a null or empty text has no evidence of its own, so that declaration, suffix and host decide; a row
without any evidence gets the corpus prior. Null declarations, suffixes and hosts say nothing.
Of labels with equally many rows the first in the alphabet are languages. Equal scores go to the language first in the alphabet. Other columns are kept under ``row``.
Without labelled rows there are no languages, and every row is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.words import LOWER, slices
from tallyhouse.operators.staging import settled

SAMPLE_ROWS = 4000  # labelled rows each language's text model is trained on at most, in expectation
LANGUAGES = 256  # the labels with most rows, at most so many, are languages: bounds the models, which go to every task
LABELS = 127  # a host has no more labels than that; of longer ones the last so many count
FEATURES = 1 << 14
EVIDENCE = 40.0
STRENGTH = 20.0
UNKNOWN = "und"
UNKNOWN_PRIOR = 1e-3
KEEP_FROM = 0.5  # posterior of a known language from which a row is kept


def trigrams(data: np.ndarray) -> np.ndarray:
    """The feature of the trigram at each byte but the last two; letters in lower case, other ASCII as a space."""
    x = LOWER[data].astype(np.uint32)
    x[(x < 97) | (x > 122) & (x < 128)] = 32
    mixed = x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)
    return (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 14)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each language in a task."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = np.frombuffer(text.as_buffer() or b"", np.uint8)
            if len(data) > 2:
                total.setdefault(language, np.zeros(FEATURES, np.int64))
                total[language] += np.bincount(trigrams(data), minlength=FEATURES)
    for language, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["language", "feature", "n"])


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-likelihood of each trigram in each, from up to about SAMPLE_ROWS rows ``id, label, text`` of each.

    Rows whose label is not among the LANGUAGES most frequent ones train nothing, but are judged like all others.
    """
    labelled = labelled.where("label is not null and text is not null")
    rows = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    rows = F.broadcast(rows.orderBy(F.desc("rows"), "label").limit(LANGUAGES))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    sample = labelled.join(rows, "label").where(place < F.lit(float(SAMPLE_ROWS << 30)) / F.col("rows"))
    rows = sample.select("label", "text").mapInArrow(_counts, "language string, feature int, n long")
    rows = rows.groupBy("language", "feature").agg(F.sum("n").alias("n")).collect()  # at most languages x FEATURES
    names = sorted({r.language for r in rows})
    model = np.full((len(names), FEATURES), 0.5)
    for r in rows:
        model[names.index(r.language), r.feature] += r.n
    return names, np.log(model / model.sum(axis=1, keepdims=True))


def text_scores(docs: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """``docs`` (columns ``row, text, declared, suffix, host``) with ``scores``: one for each language, and the unknown one."""
    table = np.ascontiguousarray(np.vstack([model, np.full((1, FEATURES), -np.log(FEATURES))]).T.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            column = batch.column(at) if at >= 0 else batch.column(0).field("text")
            parts = [scored(texts, table) for _, texts in slices(column)]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            width = table.shape[1]
            scores = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns) if i != at] + [scores],
                names=[n for n in batch.schema.names if n != "text"] + ["scores"])

    fields = [f for f in docs.schema if f.name != "text"]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("scores", T.ArrayType(T.DoubleType()))]))


def scored(texts, table: np.ndarray) -> np.ndarray:
    """Scaled log-likelihoods of each text."""
    if len(texts.data) < 3:
        return np.zeros((texts.n, table.shape[1]))
    places = trigrams(texts.data)
    n = np.maximum(0, np.diff(texts.bounds) - 2)
    found = np.zeros((texts.n, table.shape[1]))
    for i in range(table.shape[1]):
        sums = np.concatenate(([0.0], np.cumsum(table[:, i][places], dtype=np.float64)))
        first = np.minimum(texts.bounds[:-1], len(places))
        found[:, i] = sums[np.minimum(first + n, len(places))] - sums[first]
    return found * np.where(n > EVIDENCE, EVIDENCE / np.maximum(n, 1), 1.0)[:, None]


def _best(names: list[str], scores: Column) -> Column:
    """The language with the highest score; the first of equals."""
    every = F.array(*(F.lit(n) for n in names))
    return F.element_at(every, F.array_position(scores, F.array_max(scores)).cast("int"))


def parents(host: Column) -> Column:
    """A host and its parent domains, longest first: ``a.b.c, b.c, c``."""
    labels = F.split(host, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))


def _smoothed(above: Column, level: Column) -> Column:
    """Shares of a domain: its counts and STRENGTH rows that are dealt as those above it."""
    rows = F.aggregate(level["counts"], F.lit(0).cast("long"), lambda a, x: a + x)
    return F.zip_with(level["counts"], above, lambda n, share: (n + STRENGTH * share) / (rows + STRENGTH))


def fused(held: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """``held`` (``row, text, declared, suffix, host``) -> ``row, language, posterior, text_language, kept``."""
    held = held.withColumn("host", F.substring_index("host", ".", -LABELS))
    every = [*names, UNKNOWN]
    guess = _best(every, F.col("scores"))
    counted = text_scores(held.select("text", "declared", "suffix", "host"), names, model)
    counted = counted.where("scores is not null and array_max(scores) < 0").select(guess.alias("guess"), "declared", "suffix", "host")
    counted = settled(counted.groupBy("guess", "declared", "suffix", "host").agg(F.count(F.lit(1)).alias("n")), "language-counts")

    total = {r.guess: r.n for r in counted.groupBy("guess").agg(F.sum("n").alias("n")).collect()}  # one row a language
    rows = sum(total.values())
    base = [(total.get(n, 0) + 1) / (rows + len(every)) for n in every]
    base[-1] = min(base[-1], UNKNOWN_PRIOR)

    def by_value(column: str) -> DataFrame:
        """log P(value | language), one row for each value."""
        n = [F.coalesce(F.sum(F.when(F.col("guess") == x, F.col("n"))), F.lit(0)) for x in every]
        share = [F.log((c + 1) / F.lit(float(total.get(x, 0) + len(every)))) for c, x in zip(n, every)]
        return counted.where(F.col(column).isNotNull()).groupBy(column).agg(F.array(*share).alias(f"{column}_scores"))

    # Counts of every domain: of its hosts, added up. Its prior goes down from the corpus through the counts of its parents and its own.
    domain = counted.where("host is not null").select(F.explode(parents(F.col("host"))).alias("domain"), "guess", "n")
    n = [F.coalesce(F.sum(F.when(F.col("guess") == x, F.col("n"))), F.lit(0)) for x in every]
    domain = settled(domain.groupBy("domain").agg(F.array(*n).alias("counts")), "language-domains")
    above = domain.select("domain", F.explode(parents(F.col("domain"))).alias("parent"))
    above = above.join(domain.withColumnRenamed("domain", "parent"), "parent")
    above = above.select("domain", F.struct(F.length("parent").alias("length"), "counts").alias("level"))  # a parent is shorter than its children
    smoothed = F.aggregate(F.sort_array(F.collect_list("level")), F.array(*map(F.lit, base)), _smoothed)
    prior = settled(above.groupBy("domain").agg(smoothed.alias("shares")), "language-priors")

    scored_rows = text_scores(held, names, model)
    for column in ("declared", "suffix"):
        scored_rows = scored_rows.join(settled(by_value(column), f"language-{column}"), column, "left")
    scored_rows = scored_rows.join(prior.withColumnRenamed("domain", "host"), "host", "left")
    zero, flat = F.array(*(F.lit(0.0) for _ in every)), F.array(*map(F.lit, base))
    parts = [F.col("scores"), F.coalesce("declared_scores", zero), F.coalesce("suffix_scores", zero)]
    shares = F.coalesce("shares", flat)
    logs = [sum((p[i] for p in parts), F.log(shares[i])) for i in range(len(every))]
    scored_rows = scored_rows.withColumn("logs", F.array(*logs)).withColumn("top", F.array_max("logs"))
    weight = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    found = scored_rows.select("row", _best(every, F.col("logs")).alias("language"), (1 / weight).alias("posterior"), _best(every, F.col("scores")).alias("text_language"))
    return found.withColumn("kept", (F.col("language") != UNKNOWN) & (F.col("posterior") >= KEEP_FROM))


def of_documents(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """Documents: ``lang`` is the declaration, ``source`` the host; they have no address.

    The models are trained on a sample of the declarations. With ``keep_row`` the whole document is kept under ``row``.
    """
    names, model = train(docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if keep_row else F.col("doc_id")
    held = docs.select(row.alias("row"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))
    return fused(held, names, model)


def of_pages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """Pages: the ``lang`` of the html element, the host's last label, the host; the text without markup."""
    names, model = train(labelled)
    host = F.lower(F.regexp_extract("url", "://([^/?#]*)", 1))
    text = F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", "(?i)<html[^>]*\\blang=[\"']?([a-z]{2,3})", 1))
    some = lambda c: F.when(c != "", c)
    held = pages.select(F.col("page_id").alias("row"), text.alias("text"), some(declared).alias("declared"),
                        some(F.substring_index(host, ".", -1)).alias("suffix"), some(host).alias("host"))
    return fused(held, names, model)
