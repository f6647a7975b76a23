"""Partition-wise replacement, the idempotent write of the partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import remove_folder


def replace_partitions(rows: DataFrame, path: str, column: str) -> None:
    """Replace just the partitions that occur in `rows`.

    Rebalancing gives each partition files of even size and splits a large day
    over several tasks.
    """
    (
        rows.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def replace_exactly(
    spark: SparkSession, rows: DataFrame, path: str, column: str, values: Iterable[str | int]
) -> None:
    """Replace the named partitions, also those that `rows` has nothing of any more.

    `rows` should be a written table: it is read for its partitions and for its rows.
    """
    replace_partitions(rows, path, column)
    left = {row[0] for row in rows.select(column).distinct().collect()}
    for value in set(values) - left:
        remove_folder(spark, f"{path}/{column}={value}")


def rows_of_days(table: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of a day-partitioned table whose day occurs in `days`.

    The first and last day prune partitions before the scan. Distinct days are
    one row per calendar day at most, hence the broadcast.
    """
    first, last = days.agg(F.min("day"), F.max("day")).first()
    within = table.where(F.col("day").between(F.lit(first), F.lit(last)))
    wanted = F.broadcast(days.select("day").distinct())
    return within.join(wanted, "day", "left_semi").select(*table.columns)
