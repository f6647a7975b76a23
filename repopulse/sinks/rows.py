"""Shapes of serving-table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.functions.text import (
    UNKNOWN_LANGUAGE,
    UNKNOWN_NAME,
    joined_key,
    or_default,
    percent_encoded,
    trimmed_repo_key,
)
from repopulse.functions.times import compact_key, week_key


def live_metrics_rows(windows: DataFrame) -> DataFrame:
    """K1: one row per window, repository, type and language."""
    return with_live_keys(
        windows.select(
            or_default(F.col("repo_name"), UNKNOWN_NAME).alias("name"),
            or_default(F.col("event_type"), UNKNOWN_NAME).alias("event_type"),
            or_default(F.col("language"), UNKNOWN_LANGUAGE).alias("language"),
            F.coalesce("stars_count", F.lit(0)).alias("stars"),
            F.coalesce("forks_count", F.lit(0)).alias("forks"),
            F.coalesce("watchers_count", F.lit(0)).alias("watchers"),
            F.col("event_count").alias("count"),
            F.col("window_start").alias("window"),
        )
    )


def with_live_keys(live: DataFrame) -> DataFrame:
    """K1: keys and week that follow from a live row's own columns.

    Language is part of the key, so two languages of a repository in one window
    keep a row each.
    """
    parts = [F.col(name) for name in ("window", "name", "event_type", "language")]
    return live.select(
        joined_key(*parts).alias("row_key"),
        "name",
        "event_type",
        "language",
        "stars",
        "forks",
        "watchers",
        percent_encoded(F.col("name")).alias("repo_key"),
        week_key(F.col("window")).alias("week"),
        "count",
        "window",
    )


def repo_rows(seen: DataFrame) -> DataFrame:
    """K2: rows of the repository dimension."""
    return seen.select(
        percent_encoded(F.col("full_name")).alias("repo_key"), "full_name", "language"
    )


def live_event_rows(messages: DataFrame) -> DataFrame:
    """K3: one row per event. The key holds the event id, so a replay writes the same key."""
    defaults = messages.select(
        "event_timestamp",
        or_default(F.col("event_id"), "none").alias("id"),
        or_default(F.col("repo_name"), UNKNOWN_NAME).alias("repo"),
        or_default(F.col("event_type"), UNKNOWN_NAME).alias("type"),
        or_default(F.col("language"), UNKNOWN_LANGUAGE).alias("language"),
    )
    return defaults.select(
        joined_key(
            compact_key(F.col("event_timestamp")), F.col("id"), F.col("repo"), F.col("type")
        ).alias("row_key"),
        "repo",
        "type",
        "language",
        percent_encoded(F.col("repo")).alias("repo_key"),
    )


def weekly_rows(enriched: DataFrame) -> DataFrame:
    """K4: one row per day and repository, with defaults for what is missing."""
    defaults = enriched.withColumns(
        {
            "name": or_default(F.col("repo_name"), UNKNOWN_NAME),
            "day": or_default(F.col("day"), UNKNOWN_NAME),
        }
    )
    return defaults.select(
        joined_key(F.col("day"), F.col("name")).alias("row_key"),
        "name",
        F.coalesce("language", F.lit(UNKNOWN_LANGUAGE)).alias("language"),
        trimmed_repo_key(F.col("name")).alias("repo_key"),
        F.coalesce("star_count", F.lit(0)).alias("stars"),
        F.coalesce("fork_count", F.lit(0)).alias("forks"),
        F.coalesce("velocity", F.lit(0)).alias("velocity"),
        F.coalesce("fork_velocity", F.lit(0)).alias("fork_velocity"),
        F.coalesce("repo_count", F.lit(1)).alias("repo_count"),
        F.coalesce("api_stars", F.lit(0)).alias("api_stars"),
        F.coalesce("api_forks", F.lit(0)).alias("api_forks"),
        "day",
    )


def message_values(messages: DataFrame) -> DataFrame:
    """K7: messages as the topic carries them, one JSON text per row, nulls written out."""
    columns = schemas.column_names(schemas.MESSAGE)
    return messages.select(
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")
    )
