"""Windowed and daily aggregates and day-over-day velocity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions.times import bound_text
from repopulse.operators.cleaning import FORK_EVENT, STAR_EVENT

# Fixed value: width of the activity windows.
WINDOW_WIDTH = "10 minutes"


def windowed_activity(messages: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """A1, R2: events and highest counts per window, repository, type and language.

    Runs on a table as well as on a stream, where the watermark set on the
    event time bounds state. Counting is partial before the shuffle, so a hot
    repository is no hot task.
    """
    highest = [F.max(name).alias(name) for name in ("stars_count", "forks_count", "watchers_count")]
    return (
        messages.groupBy(
            F.window("event_timestamp", width), "repo_name", "event_type", "language"
        )
        .agg(F.count("*").alias("event_count"), *highest)
        .select(
            bound_text(F.col("window.start")).alias("window_start"),
            bound_text(F.col("window.end")).alias("window_end"),
            "repo_name",
            "event_type",
            "language",
            "stars_count",
            "forks_count",
            "watchers_count",
            "event_count",
        )
    )


def daily_metrics(events: DataFrame) -> DataFrame:
    """A2, A3: star and fork counts per repository and day.

    `repo_count` is 1 on every row, as each row is one repository; summing it
    over a day gives that day's distinct repositories.
    """
    kind = F.col("event_type")
    return (
        events.groupBy("day", "repo_name")
        .agg(
            F.count_if(kind == STAR_EVENT).alias("star_count"),
            F.count_if(kind == FORK_EVENT).alias("fork_count"),
            F.count("*").alias("total_events"),
        )
        .select(
            F.col("day").cast("string").alias("day"),
            "repo_name",
            "star_count",
            "fork_count",
            F.lit(1).cast("bigint").alias("repo_count"),
            "total_events",
        )
    )


def unprocessed(daily: DataFrame, processed: DataFrame) -> DataFrame:
    """rows of days not processed yet.

    Distinct days are one row per calendar day at most, hence the broadcast;
    Spark then moves the join below the aggregate, next to the scan.
    """
    days = F.broadcast(processed.select("day").distinct())
    return daily.join(days, "day", "left_anti")


def daily_velocity(daily: DataFrame) -> DataFrame:
    """Change of stars and forks since the repository's previous active day.

    The first day's change is the count itself. Groups hold one row per active
    day, never more than the days of the input.
    """
    by_day = Window.partitionBy("repo_name").orderBy("day")
    return daily.withColumns(
        {
            "velocity": F.col("star_count") - F.lag("star_count", 1, 0).over(by_day),
            "fork_velocity": F.col("fork_count") - F.lag("fork_count", 1, 0).over(by_day),
        }
    )


def incremental_velocity(daily: DataFrame, snapshot: DataFrame) -> DataFrame:
    """W1 continued from W2: the first new day of a repository follows its last stored one.

    `snapshot` must only hold days before those of `daily`.
    """
    earlier = snapshot.select(
        F.col("name").alias("repo_name"), "last_stars", "last_forks"
    )
    by_day = Window.partitionBy("repo_name").orderBy("day")
    joined = daily.join(earlier, "repo_name", "left")
    previous = {
        column: F.coalesce(F.lag(column).over(by_day), F.col(carried), F.lit(0))
        for column, carried in (("star_count", "last_stars"), ("fork_count", "last_forks"))
    }
    return joined.select(
        *daily.columns,
        (F.col("star_count") - previous["star_count"]).alias("velocity"),
        (F.col("fork_count") - previous["fork_count"]).alias("fork_velocity"),
    )


def as_snapshot(weekly: DataFrame) -> DataFrame:
    """Daily rows in the shape of snapshot rows."""
    return weekly.select(
        "name",
        F.col("stars").alias("last_stars"),
        F.col("forks").alias("last_forks"),
        F.col("api_stars").alias("last_api_stars"),
        F.col("api_forks").alias("last_api_forks"),
        F.col("day").alias("last_day"),
    )


def merged_snapshots(rows: DataFrame, *within: str) -> DataFrame:
    """K5: the row of the latest day per repository, or per repository and further columns."""
    columns = ["last_stars", "last_forks", "last_api_stars", "last_api_forks"]
    day = F.col("last_day").cast("date")
    return (
        rows.groupBy("name", *within)
        .agg(*[F.max_by(c, day).alias(c) for c in columns], F.max(day).alias("last_day"))
        .withColumn("last_day", F.col("last_day").cast("string"))
    )


def last_days(weekly: DataFrame) -> DataFrame:
    """Each repository's counts on its latest day."""
    return merged_snapshots(as_snapshot(weekly))


def distinct_repos_by_language(weekly: DataFrame) -> DataFrame:
    """A4: distinct repositories per language and day.

    Daily rows are already one per repository, so their `repo_count` adds up to
    the distinct count without a second shuffle.
    """
    return weekly.groupBy("day", "language").agg(F.sum("repo_count").alias("repos"))


def merged_distinct_repos(language_days: DataFrame) -> DataFrame:
    """A4 over any days: about how many distinct repositories each language has in them.

    The days' sketches are merged, so no daily row is read. Up to a few hundred
    repositories the numbers are exact, beyond that the standard error is 1.04 over the
    square root of the sketches' registers.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("repo_sketch"))
    return language_days.groupBy("language").agg(merged.alias("repos"))


def latest_by_key(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    """K1: the newest version of every key in a change log."""
    values = [name for name in log.columns if name not in (*keys, order)]
    newest = [F.max_by(name, order).alias(name) for name in values]
    return log.groupBy(*keys).agg(*newest, F.max(order).alias(order))
