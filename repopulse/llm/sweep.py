"""Global order over many partitions: the rows of each know their partition's number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import staged


def in_order(spark: SparkSession, rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows in ranges of the given order, with `part`, the number of their range.

    Equal rows may lie in neighbouring ranges, so a frequent value does not fill
    one of them. The rows are staged first, as ranges are found from a sample of
    them, and again with their numbers, which thereby stay the same for all that
    follows.
    """
    held = staged(spark, rows.withColumn("row_id", F.monotonically_increasing_id()), "unordered")
    ranged = held.repartitionByRange(*order, "row_id")
    return staged(spark, ranged.withColumn("part", F.spark_partition_id()), "ordered")
