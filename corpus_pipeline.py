"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmarks, packing.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept, and returns the columns of `documents`; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import decontamination, divergence, packing, simhash, substrings


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules. Null and empty texts fail; repeated rows all pass or fail."""
    return divergence.keep_good(spark, docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the least id. Null texts are a group."""
    return simhash.keep_one(spark, docs, shingle=3, max_bits=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds. Null texts stay null."""
    left = substrings.without_repeats(spark, docs, window=50)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return left.withColumn("n_chars", length.cast("long"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item. Null texts stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_benchmark(spark, docs, benchmark, window=10)


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents' ids in sequences of 4096. A null text is one end; no rows give none."""
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("packing", mixture_packing),
]

#: Packing needs token ids, and fingerprints XXH64: SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage working on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
