from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from repopulse.operators import cleaning, enrichment, metrics
from repopulse.sample import tables as sample
from repopulse.sample.queries import QUERIES

# Queries that run jobs or streams of their own before they return.
EAGER = {
    "stream_windowed_activity", "stream_dedup_windowed", "stream_repos", "stream_live_feed",
    "stream_canonical_events", "daily_job", "snapshot_job", "processed_days_job", "backfill_job",
    "raw_file_events", "archive_read", "archive_quarantine", "breakout_scores", "breakout_checks", "ai_insights",
    "stream_repos_log", "stream_late_rows", "stream_recovered", "stray_events_job",
    "breakout_backtest", "distinct_repos_range", "archive_damage",
    "daily_job_stray_days", "daily_job_mixed_files", "late_day_job", "stream_live_feed_restart",
    "dashboard_trending_now", "dashboard_rising_languages", "dashboard_historical_trends",
    "dashboard_trending_daily",
}
TOP_K = {
    "live_metrics_scan", "top_velocity", "trending_now", "rising_languages",
    "language_totals", "activity_feed", "trending_daily", "weekly_scan",
    "prefix_scan", "insight_panel",
}
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
ALL_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_no_all_pairs_no_global_sort(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not [word for word in (*PYTHON, *ALL_PAIRS) if word in plan]
    assert "rangepartitioning" not in plan
    if name in TOP_K:
        assert "TakeOrderedAndProject" in plan


@pytest.fixture
def shuffled(spark):
    """Plans as they are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_enrichment_reuses_the_partitioning_of_velocity(shuffled, sf_dir):
    plan = plan_of(QUERIES["weekly_metrics"](shuffled, sf_dir))
    by_day = [keys for keys in exchanges(plan) if "day" in keys]
    by_repo = [keys for keys in exchanges(plan) if "day" not in keys]
    # Counting needs one shuffle, velocity one, and each of three metadata tables one.
    assert len(by_day) == 1 and len(by_repo) == 4


def test_counting_is_partial_before_the_shuffle(spark, sf_dir):
    for name in ("daily_metrics", "windowed_activity", "repos_dimension", "last_day_snapshot"):
        assert "partial_" in plan_of(QUERIES[name](spark, sf_dir))


def test_relevant_types_and_columns_reach_the_scan(spark, sf_dir):
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(
        cleaning.relevant(stored, "event_type").groupBy("user_id").agg(F.count("*").alias("n"))
    )
    assert "PushedFilters: [Or(EqualTo(event_type" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_newest_day_prunes_partitions(spark, folder):
    days = spark.createDataFrame([(f"2026-04-{d}", 1) for d in (10, 11)], "day string, stars bigint")
    days.write.partitionBy("day").parquet(folder)
    stored = spark.read.schema("stars bigint, day string").parquet(folder)
    newest = stored.where(F.col("day") == stored.agg(F.max("day")).scalar())
    assert re.search(r"PartitionFilters: \[.*day.*Subquery", plan_of(newest))


def test_skipping_processed_days_comes_before_the_aggregate(spark, sf_dir):
    daily = metrics.daily_metrics(cleaning.archive_events(sample.archive(spark, sf_dir)))
    done = spark.createDataFrame([("2024-01-02",)], "day string")
    plan = plan_of(metrics.unprocessed(daily, done))
    assert plan.index("partial_count") < plan.index("LeftAnti")


def test_a_hot_repository_is_split_in_the_event_join(shuffled):
    """Half of the rows share one key; the join reads its partition in several pieces."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: shuffled.conf.get(name, None) for name in small}
    for name, value in small.items():
        shuffled.conf.set(name, value)
    try:
        number = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 997)
        events = shuffled.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
            sample.repo_of(number).alias("repo_name"),
        )
        known = shuffled.range(997).select(
            sample.repo_of(F.col("id")).alias("repo_name"), F.lit("Go").alias("language")
        )
        joined = enrichment.attach_metadata(events, known)
        assert joined.agg(F.count_if(F.col("language") == "Go")).first()[0] == 200_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.select("event_id", "language")
        rows.collect()
        assert "skewed" in plan_of(rows)
    finally:
        for name, value in before.items():
            shuffled.conf.unset(name) if value is None else shuffled.conf.set(name, value)
