"""The corpus pipeline: five stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import byte_bpe, decontaminate, quality_rules, simhash, substring_dedup
from orderlens.llm.common import read, ship, written
from orderlens.llm.queries import RANKS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.drop_poor(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8): that with the smallest id."""
    ship(spark)
    return simhash.drop_similar(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; documents without a repeat keep their text as it is.

    A document of which nothing is left is dropped; ``n_chars`` follows the new text.
    """
    ship(spark)
    found = substring_dedup.dedup_substrings(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    left = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).withColumn("text", text)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    ship(spark)
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    ship(spark)
    ranks = byte_bpe.shared_ranks(spark, public_tokenizers.path(RANKS))
    found = byte_bpe.encode_checked(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("token_ids"), "ids_sha256", "round_trip")


STAGES = [
    ("quality rules", quality),
    ("near dedup", near_dedup),
    ("substring dedup", substring),
    ("decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: Suffix trees, fingerprints and BPE have no DuckDB text; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}-{name.replace(' ', '-')}")
    return docs
