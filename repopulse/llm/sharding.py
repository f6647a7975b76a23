"""Contiguous shards of nearly equal bytes, from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.sweep import in_order

#: Bytes that a document takes besides its text.
FRAME = 8


def shards(
    spark: SparkSession, docs: DataFrame, count: int, carry: list[str] | None = None
) -> DataFrame:
    """The columns named by `carry` in the struct `row`, with shard and slot of each document.

    Documents are put in the order of doc_id, null first, then of size and
    checksum. Each partition sums its sizes, the totals of the partitions before
    it are added, and a document belongs to the shard in which the middle of its
    bytes falls when all bytes are cut at `count` equal targets. So shards are
    contiguous, and differ from their target by no more than half of the documents
    at their two ends. `slot` counts the documents of a shard from 0, `size` is
    the text's UTF-8 bytes, none for null, plus FRAME. An empty table has no
    shards, and with few documents some shards stay empty.
    """
    kept = docs.columns if carry is None else carry
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in kept)).alias("row"),
        F.col("doc_id").alias("key"),
        (F.octet_length(text) + FRAME).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = ["key", "size", "text_crc32"]
    ordered = in_order(spark, rows, *order)
    totals = ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    total = totals.agg(F.sum("bytes")).first()[0] or 1
    own = Window.partitionBy("part").orderBy(*order, "row_id")
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ordered.withColumn("place", F.row_number().over(own) - 1)
        .withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .join(starts, "part")
        .withColumn("place", F.col("place") + F.col("rows_before"))
        .withColumn("start", F.col("start") + F.col("bytes_before"))
    )
    middle = 2 * F.col("start") + F.col("size")
    placed = placed.withColumn(
        "shard", F.floor(middle * F.lit(count) / F.lit(2 * total)).cast("int")
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(firsts, "shard").select(
        "row", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write_shards(spark: SparkSession, docs: DataFrame, path: str, count: int) -> None:
    """One folder of Parquet files per shard, `shard=<number>`, with the slot in each row.

    Rows of a shard may be spread over several files.
    """
    found = shards(spark, docs, count)
    rows = F.struct("row.*").alias("document")
    found.select(rows, "slot", "shard").write.partitionBy("shard").parquet(path)
