"""Joins that add project metadata.

Metadata tables may hold several rows per repository; each is collapsed to one by
the key of its join, before the join and without a shuffle beyond it. None of the
joins is forced to broadcast: adaptive execution broadcasts a side once its measured size is below
the threshold, and otherwise shuffles both sides and splits the partition of a
hot repository. The daily joins see one row per repository and day, so only the
event-level join can meet a hot one at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.text import (
    UNKNOWN_LANGUAGE,
    has_owner,
    key_tail,
    known_language,
    or_default,
    percent_encoded,
)

COUNTS = ("stars_count", "forks_count", "watchers_count")


def one_per_repo(metadata: DataFrame) -> DataFrame:
    """One row per `repo_name`: that with the highest counts, then the last language by text."""
    values = [c for c in (*COUNTS, "language") if c in metadata.columns]
    best = metadata.groupBy("repo_name").agg(F.max(F.struct(*values)).alias("best"))
    return best.select("repo_name", "best.*")


def attach_metadata(messages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata of each message's repository; `Unknown` and zeros on a miss.

    The collapsed metadata is rebalanced, so that both sides of the join are plain
    shuffles and the partition of a hot repository can be split.
    """
    joined = messages.join(one_per_repo(metadata).hint("rebalance"), "repo_name", "left").withColumn(
        "language", or_default(F.col("language"), UNKNOWN_LANGUAGE)
    )
    counts = {name: F.coalesce(name, F.lit(0)) for name in COUNTS if name in metadata.columns}
    return joined.withColumns(counts)


def language_lookup(repos: DataFrame) -> DataFrame:
    """Repositories whose language is known, once each; of several the first by text."""
    known = repos.select(
        F.col("full_name").alias("repo_name"),
        known_language(F.col("language")).alias("language"),
    ).where(F.col("language").isNotNull())
    return known.groupBy("repo_name").agg(F.min("language").alias("language"))


def _tier(metadata: DataFrame, alias: str) -> DataFrame:
    return one_per_repo(metadata).select(
        "repo_name",
        F.struct(
            or_default(F.col("language"), UNKNOWN_LANGUAGE).alias("language"),
            F.coalesce("stars_count", F.lit(0)).alias("api_stars"),
            F.coalesce("forks_count", F.lit(0)).alias("api_forks"),
        ).alias(alias),
    )


def enrich_repos(
    rows: DataFrame,
    repos: DataFrame,
    tiers: Sequence[DataFrame] = (),
    first_known_counts: bool = False,
) -> DataFrame:
    """Language and counts for every row, from the first source that has the repository.

    A language known to the dimension wins and carries no counts. Otherwise the
    first tier holding the repository decides language and counts together, even
    if its language is `Unknown`. The first tier is asked by owner and name, so
    names without an owner skip it. `first_known_counts` takes the
    counts of the first tier that has the repository for dimension hits too.

    All joins use the one key, so rows already partitioned by it stay in place.
    """
    found = rows.join(
        language_lookup(repos).withColumnRenamed("language", "dimension_language"),
        "repo_name",
        "left",
    )
    candidates: list[Column] = []
    for number, metadata in enumerate(tiers, start=1):
        alias = f"tier_{number}"
        found = found.join(_tier(metadata, alias), "repo_name", "left")
        asked = has_owner(F.col("repo_name")) if number == 1 else F.lit(True)
        candidates.append(F.when(asked, F.col(alias)))
    miss = F.struct(
        F.lit(UNKNOWN_LANGUAGE).alias("language"),
        F.lit(0).cast("bigint").alias("api_stars"),
        F.lit(0).cast("bigint").alias("api_forks"),
    )
    answer = F.coalesce(*candidates, miss)
    in_dimension = F.col("dimension_language").isNotNull()
    count_free = in_dimension & F.lit(not first_known_counts)
    return found.select(
        *rows.columns,
        F.coalesce("dimension_language", answer["language"]).alias("language"),
        F.when(count_free, F.lit(0)).otherwise(answer["api_stars"]).alias("api_stars"),
        F.when(count_free, F.lit(0)).otherwise(answer["api_forks"]).alias("api_forks"),
    )


def first_seen_repos(live_rows: DataFrame) -> DataFrame:
    """J5 within one batch: each repository with the language first seen for it.

    "First" is the earliest window, then type and language by text.
    """
    order = F.struct("window", "event_type", "language")
    return (
        live_rows.groupBy(F.col("name").alias("full_name"))
        .agg(F.min_by("language", order).alias("language"))
        .select(percent_encoded(F.col("full_name")).alias("repo_key"), "full_name", "language")
    )


def absent_repos(candidates: DataFrame, repos: DataFrame) -> DataFrame:
    """J5 against the table: candidates it does not hold yet; known rows never change."""
    return candidates.join(repos.select("repo_key"), "repo_key", "left_anti").select(
        "repo_key", "full_name", "language"
    )


def backfill_candidates(weekly: DataFrame) -> DataFrame:
    """Daily rows without a known language."""
    return weekly.where(
        F.contains("row_key", F.lit("#")) & known_language(F.col("language")).isNull()
    )


def language_updates(weekly: DataFrame, repos: DataFrame, metadata: DataFrame) -> DataFrame:
    """Languages found for daily rows that lack one, dimension before metadata."""
    named = F.coalesce(F.nullif("name", F.lit("")), key_tail(F.col("row_key")))
    candidates = backfill_candidates(weekly).select(
        "row_key", "day", named.alias("repo_name")
    )
    from_dimension = language_lookup(repos).withColumnRenamed("language", "dimension_language")
    from_metadata = language_lookup(
        metadata.select(F.col("repo_name").alias("full_name"), "language")
    ).withColumnRenamed("language", "metadata_language")
    return (
        candidates.join(from_dimension, "repo_name", "left")
        .join(from_metadata, "repo_name", "left")
        .select(
            "row_key",
            "day",
            F.coalesce("dimension_language", "metadata_language").alias("found_language"),
        )
        .where(F.col("found_language").isNotNull())
    )


def with_languages(weekly: DataFrame, updates: DataFrame) -> DataFrame:
    """Daily rows with the found languages filled in; all others unchanged."""
    return (
        weekly.join(updates, ["row_key", "day"], "left")
        .withColumn("language", F.coalesce("found_language", "language"))
        .select(*weekly.columns)
    )
