"""One query per operator, over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import (
    conversations,
    cotraining,
    decontamination,
    divergence,
    langid,
    licenses,
    lines,
    merkle,
    packing,
    sharding,
    simhash,
    substrings,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cotraining.classify(
        spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )
    return found.withColumnRenamed("good", "kept")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "kind", "place", "license", "shared", "n_bigrams", "dice"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence.judge(spark, _table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "reason",
        "reference",
    )


# The rules that pages are judged by (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(verdict, host, path)")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(spark, pages, rules).select("row.page_id", "host", "path", "rule", "verdict")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(spark, _table(spark, sf_dir, "documents"), 24, carry=["doc_id"])
    return found.select(
        "row.doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(spark, _table(spark, sf_dir, "documents"), path)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(
        spark,
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"),
    )
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(spark, _table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.lower(F.hex("kept_digest")).alias("kept_sha256")
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = langid.identify(spark, docs, path)
    return found.select("row.doc_id", "held_out", "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


# The fields that a document's leaf is made of, and how often a row is tampered with.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    fields = [F.col(c) for c in LEAF_FIELDS]
    leaf = merkle.leaf_hash(*fields)
    tampered = merkle.leaf_hash(*(f + 1 if c == "n_chars" else f for c, f in zip(LEAF_FIELDS, fields)))
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    # Read once for both hashes; of the rest only the id goes on.
    given = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(chosen, tampered).alias("tampered"))
    found = merkle.manifest(spark, given, F.col("leaf"), carry=["doc_id", "tampered"])
    shown = F.coalesce("row.tampered", "leaf")
    return found.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(shown, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults that follow from a checksum of conversation and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    marked = rows.select("conv_id", "turn", "role", text("text").alias("text"), fault.alias("fault"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.where("fault != 0").withColumn("copy", copies).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    found = conversations.repaired_digests(spark, damaged(given))
    # Conversations that lost all their rows have neither faults nor edits.
    ids = given.select("conv_id").distinct().withColumnRenamed("conv_id", "id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.repeated_lines(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.col("kept_digest").alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    name: query for name, query in globals().items() if name.startswith("op")
}
