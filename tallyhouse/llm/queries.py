"""The operators over the given tables, with production parameters, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    divergence, jaccard, language, max_sketch, mixing, oracles, quality, shards, token_files, tool_links, trie_bpe, url_rules, vector_groups,
    wrappers,
)
from tallyhouse.llm.words import small_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DOMAIN = "CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN 'web' WHEN source LIKE 'src1_' THEN 'books' ELSE 'news' END"
WEIGHTS = {"domain": {"web": 50, "books": 30, "news": 20}, "language": {"en": 50, "de": 20, "fr": 20, "es": 10}}
SEED = "mix-1"
ORACLES |= oracles.ORACLES | {"op2_mixing": oracles.mixing(DOMAIN, SEED, (3, 5), 2, WEIGHTS)}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a vocabulary file lies; the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_file() -> str:
    return vocabulary("word_bpe_49k.json")


def mixed(docs: DataFrame, share: tuple[int, int], epochs: int, unlisted: int | None = None) -> DataFrame:
    levels = {"domain": F.expr(DOMAIN), "language": F.col("lang"), "source": F.col("source")}
    return mixing.mix(docs, levels, WEIGHTS, share, epochs, SEED, unlisted=unlisted)


@query
def op1_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.ledger(table(spark, folder, "documents"))
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.mask("base"))) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), quality.verdict().alias("kept"), "fail_bits")


@query
def quality_ablation(spark: SparkSession, folder: str) -> DataFrame:
    return quality.ablation(quality.ledger(table(spark, folder, "documents")))


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixed(table(spark, folder, "documents"), (3, 5), 2, unlisted=0)  # as in its SQL
    return found.select("row.doc_id", "domain", "language", "source", F.col("epoch").cast("long").alias("epoch"))


@query
def op3_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return trie_bpe.encode_digests(table(spark, folder, "documents"), word_file())


@query
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_files.crc_of_ids(files)


@query
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    bad = F.expr("quality = 0 or toxic = 1")
    return url_rules.judged(table(spark, folder, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")))


@query
def op6_tool_links(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = tool_links.chat_calls(table(spark, folder, "conversations"))
    found = tool_links.linked(calls, results, tool_links.CHAT_SCHEMAS)
    return found.withColumn("problems", F.array_join("problems", "; "))


@query
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.of_documents(table(spark, folder, "documents")).withColumnRenamed("row", "doc_id")


@query
def language_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labelled = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")
    return language.of_pages(table(spark, folder, "pages"), labelled).withColumnRenamed("row", "page_id")


@query
def op8_vector_groups(spark: SparkSession, folder: str) -> DataFrame:
    return vector_groups.vector_groups(table(spark, folder, "embeddings"))


@query
def op9_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_texts(table(spark, folder, "pages"))


@query
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


@query
def op11_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = shards.read_shards(spark, shards.write_shards(docs), docs)
    return found.select(
        "row.doc_id", "size", shards.text_crc32(F.col("row.text")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op12_max_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return max_sketch.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))
