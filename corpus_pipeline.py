"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import hostrules, neardup, packing, pii, substrings
from casemill.llm.text import stored


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought up to date with the text."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return docs.withColumn("n_chars", size) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return hostrules.passed(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, by sets of five words, one document stays."""
    return neardup.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 35 words that occur again anywhere go."""
    return _sized(substrings.without_repeats(docs))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind."""
    return _sized(pii.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("personal_data", privacy),
    ("packing", pack),
]

ORACLE_SQL = None  # near-duplicate components and merges of tokens are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
