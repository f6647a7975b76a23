from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import records
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators import metrics

DAILY = "day string, repo_name string, star_count bigint, fork_count bigint"


def test_windows_keep_languages_apart_and_take_maxima(spark):
    data = spark.createDataFrame(
        [
            ("2026-04-13 10:00:00", "a/b", "WatchEvent", "Go", 3, 1, 1),
            ("2026-04-13 10:09:59", "a/b", "WatchEvent", "Go", 9, None, 2),
            ("2026-04-13 10:09:59", "a/b", "WatchEvent", "Unknown", 1, 1, 1),
            ("2026-04-13 10:10:00", "a/b", "WatchEvent", "Go", 4, 1, 1),
        ],
        "t string, repo_name string, event_type string, language string, stars_count bigint, "
        "forks_count bigint, watchers_count bigint",
    ).withColumn("event_timestamp", F.col("t").cast("timestamp"))
    found = records(
        metrics.windowed_activity(data),
        "window_start", "window_end", "language", "stars_count", "forks_count", "event_count",
    )
    assert found == [
        ("2026-04-13 10:00:00", "2026-04-13 10:10:00", "Go", 9, 1, 2),
        ("2026-04-13 10:00:00", "2026-04-13 10:10:00", "Unknown", 1, 1, 1),
        ("2026-04-13 10:10:00", "2026-04-13 10:20:00", "Go", 4, 1, 1),
    ]
    assert metrics.windowed_activity(data, width="5 minutes").count() == 4


def random_events(seed, skewed):
    """Events in which, if skewed, one repository holds a third of all rows."""
    rng = random.Random(seed)
    names = [f"o/r{i}" for i in range(9)]
    return [
        (
            rng.choice(["WatchEvent", "ForkEvent"]),
            "o/hot" if skewed and rng.random() < 0.34 else rng.choice(names),
            f"2026-04-{rng.randint(10, 20)}",
        )
        for _ in range(600)
    ]


def events(spark, rows):
    data = spark.createDataFrame(rows, "event_type string, repo_name string, day string")
    return data.withColumn("day", F.col("day").cast("date"))


@pytest.mark.parametrize("seed, skewed", [(1, False), (2, True), (3, True)])
def test_daily_velocity_equals_brute_force(spark, seed, skewed):
    rows = random_events(seed, skewed)
    counts = Counter((repo, day, kind) for kind, repo, day in rows)
    days = defaultdict(set)
    for _, repo, day in rows:
        days[repo].add(day)
    wanted = []
    for repo, active in days.items():
        stars = forks = 0
        for day in sorted(active):
            s, f = counts[repo, day, "WatchEvent"], counts[repo, day, "ForkEvent"]
            wanted.append((repo, day, s, f, s - stars, f - forks))
            stars, forks = s, f
    found = metrics.daily_velocity(metrics.daily_metrics(events(spark, rows)))
    columns = ("repo_name", "day", "star_count", "fork_count", "velocity", "fork_velocity")
    assert records(found, *columns) == sorted(wanted, key=repr)


def test_velocity_telescopes_to_the_last_count(spark):
    daily = metrics.daily_metrics(events(spark, random_events(4, True)))
    moved = metrics.daily_velocity(daily)
    total = moved.groupBy("repo_name").agg(F.sum("velocity").alias("moved"))
    last = daily.groupBy("repo_name").agg(F.max_by("star_count", "day").alias("last"))
    assert total.join(last, "repo_name").where("moved <> last").count() == 0


def test_velocity_over_a_gap_and_downwards(spark):
    data = spark.createDataFrame(
        [("2026-04-10", "a", 5, 0), ("2026-04-14", "a", 2, 1), ("2026-04-10", "b", 0, 3)], DAILY
    )
    found = records(metrics.daily_velocity(data), "repo_name", "day", "velocity", "fork_velocity")
    assert found == [("a", "2026-04-10", 5, 0), ("a", "2026-04-14", -3, 1), ("b", "2026-04-10", 0, 3)]


def test_incremental_velocity_starts_from_the_snapshot(spark):
    daily = spark.createDataFrame(
        [("2026-04-14", "a", 7, 1), ("2026-04-15", "a", 6, 1), ("2026-04-14", "new", 2, 2)], DAILY
    )
    snapshot = spark.createDataFrame(
        [("a", 5, 4, 0, 0, "2026-04-10"), ("other", 1, 1, 0, 0, "2026-04-10")], schemas.SNAPSHOT
    )
    found = metrics.incremental_velocity(daily, snapshot)
    assert records(found, "repo_name", "day", "velocity", "fork_velocity") == [
        ("a", "2026-04-14", 2, -3),
        ("a", "2026-04-15", -1, 0),
        ("new", "2026-04-14", 2, 2),
    ]
    empty = metrics.incremental_velocity(daily, schemas.empty(spark, schemas.SNAPSHOT))
    assert records(empty) == records(metrics.daily_velocity(daily).select(*empty.columns))


def test_snapshots_merge_to_the_later_day(spark):
    old = spark.createDataFrame(
        [("a", 1, 1, 1, 1, "2026-04-10"), ("b", 2, 2, 2, 2, "2026-04-12")], schemas.SNAPSHOT
    )
    new = spark.createDataFrame(
        [("a", 9, None, 9, 9, "2026-04-11"), ("b", 8, 8, 8, 8, "2026-04-11")], schemas.SNAPSHOT
    )
    columns = old.columns
    assert records(metrics.merged_snapshots(old.unionByName(new)), *columns) == [
        ("a", 9, None, 9, 9, "2026-04-11"),
        ("b", 2, 2, 2, 2, "2026-04-12"),
    ]


def test_unprocessed_skips_whole_days(spark):
    data = events(spark, [("WatchEvent", "a", "2026-04-10"), ("WatchEvent", "a", "2026-04-11")])
    done = spark.createDataFrame([("2026-04-10",)], "day string")
    daily = metrics.daily_metrics(data)
    assert records(metrics.unprocessed(daily, done), "day") == [("2026-04-11",)]
    assert metrics.unprocessed(daily, schemas.empty(spark, "day string")).count() == 2


def test_repo_counts_add_up_to_distinct_repositories(spark):
    data = spark.createDataFrame(
        [("d1", "Go", "a", 1), ("d1", "Go", "b", 1), ("d1", "C", "c", 1), ("d2", "Go", "a", 1)],
        "day string, language string, name string, repo_count bigint",
    )
    found = metrics.distinct_repos_by_language(data)
    assert records(found) == [("d1", "C", 1), ("d1", "Go", 2), ("d2", "Go", 1)]


def test_latest_by_key(spark):
    log = spark.createDataFrame([("k", 1, 0), ("k", 3, 2), ("k", 2, 1), ("l", None, 5)], "k string, v bigint, b bigint")
    assert records(metrics.latest_by_key(log, ["k"], "b")) == [("k", 3, 2), ("l", None, 5)]


def test_empty_inputs_give_empty_typed_results(spark):
    nothing = events(spark, [])
    daily = metrics.daily_velocity(metrics.daily_metrics(nothing))
    assert daily.count() == 0
    assert dict(daily.dtypes)["velocity"] == "bigint"
