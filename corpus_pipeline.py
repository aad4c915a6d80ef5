"""Raw documents to token digests in five stages, each written to the shared folder before the next.

Quality rules and language identification reject documents, near duplicates are reduced to one of each group, sources
are mixed to target weights, and what is left is encoded. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import jaccard, language, quality, queries, trie_bpe
from tallyhouse.llm.words import small_batches
from tallyhouse.operators.staging import settled


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    small_batches(spark)
    return quality.apply_policy(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    small_batches(spark)
    return language.of_documents(docs, keep_row=True).where("kept").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    small_batches(spark)
    return jaccard.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights: four fifths of all tokens, each document once at most."""
    small_batches(spark)
    return queries.mixed(docs, (4, 5), 1).select("row.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, as digests."""
    small_batches(spark)
    return trie_bpe.encode_digests(docs, queries.word_file())


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("jaccard_join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe_encoding", encoding_stage),
]

#: Language models and digests of encodings have no SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
