"""Filters and projections that clean the event feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.text import UNKNOWN_NAME
from repopulse.functions.times import archive_time, stream_time

# The two kinds of event that say a repository gains attention.
STAR_EVENT = "WatchEvent"
FORK_EVENT = "ForkEvent"
# Fixed value: how late an event may arrive for the windows.
LATENESS = "5 minutes"
# How long published ids are remembered; far beyond the windows' lateness, as an
# event later than this is dropped although a window might still want it.
DUPLICATE_MEMORY = "1 hour"


def relevant(events: DataFrame, type_column: str = "type") -> DataFrame:
    """star and fork events only."""
    kind = F.col(type_column)
    return events.where((kind == STAR_EVENT) | (kind == FORK_EVENT))


def canonical_repo() -> Column:
    """the parent project for events about a fork, else the event's repository.

    Any absent piece, the fork record itself included, falls back to the
    event's own repository, and an absent repository to empty text.
    """
    own = F.coalesce(F.col("repo.name"), F.lit(""))
    fork = F.col("payload.forkee")
    is_fork = F.coalesce(fork["fork"], F.lit(False))
    return F.when(is_fork, F.coalesce(fork["parent"]["full_name"], own)).otherwise(own)


def resolve_raw_events(raw: DataFrame) -> DataFrame:
    """raw events as messages without metadata, with their event time."""
    return relevant(raw).select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        canonical_repo().alias("repo_name"),
        F.coalesce("actor.login", F.lit(UNKNOWN_NAME)).alias("actor"),
        F.coalesce("created_at", F.lit("")).alias("created_at"),
        stream_time(F.col("created_at")).alias("event_timestamp"),
    )


def valid_messages(messages: DataFrame) -> DataFrame:
    """messages with a time, a repository and a type; empty text passes."""
    return messages.dropna(subset=["event_timestamp", "repo_name", "event_type"])


def archive_events(archive: DataFrame) -> DataFrame:
    """flat star and fork events of the archive with their UTC day.

    Rows that could not be grouped are dropped here, before any shuffle.
    """
    return (
        relevant(archive)
        .select(
            F.col("type").alias("event_type"),
            F.col("repo.name").alias("repo_name"),
            "created_at",
            archive_time(F.col("created_at")).cast("date").alias("day"),
        )
        .dropna(subset=["repo_name", "day"])
    )


def distinct_events(events: DataFrame) -> DataFrame:
    """R7 over a finished table: one row per event id.

    An aggregate rather than a ranking, so copies collapse on the map side and
    a heavily copied id never gathers in one task. Of differing copies the
    smallest row is kept, whatever the order of input.
    """
    others = [name for name in events.columns if name != "event_id"]
    kept = events.groupBy("event_id").agg(F.min(F.struct(*others)).alias("row"))
    return kept.select("event_id", "row.*").select(*events.columns)


def with_lateness(messages: DataFrame, delay: str = LATENESS) -> DataFrame:
    """The one watermark that duplicate memory and windows share."""
    return messages.withWatermark("event_timestamp", delay)


def distinct_event_stream(events: DataFrame, spread_copies: bool = True) -> DataFrame:
    """R7 over a stream with a watermark: one row per event id within its delay.

    Copies further apart than the delay are not recognised, and events later
    than the delay are dropped. A stream has no partial aggregate to collapse
    copies before the shuffle, so with `spread_copies` each input partition
    first makes its own ids distinct: the copies of one id then go to as many
    tasks as there are input partitions, and no more than one from each meets in
    the final step. That costs a second pass of state; turn it off if no id is
    copied a lot.
    """
    if spread_copies:
        events = (
            events.withColumn("source_partition", F.spark_partition_id())
            .dropDuplicatesWithinWatermark(["event_id", "source_partition"])
            .drop("source_partition")
        )
    return events.dropDuplicatesWithinWatermark(["event_id"])
