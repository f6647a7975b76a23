from __future__ import annotations

import json

from conftest import records
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators import cleaning
from repopulse.sources.feed import parse_messages

FORK = {"fork": True, "parent": {"full_name": "up/stream"}}


def raw(spark, payloads, kind="ForkEvent"):
    lines = []
    for number, payload in enumerate(payloads):
        event = {
            "id": str(number),
            "type": kind,
            "repo": {"name": "me/copy"},
            "actor": {"login": "me"},
            "created_at": "2026-04-13T10:00:00Z",
        }
        if payload != "absent":
            event["payload"] = payload
        lines.append((json.dumps(event),))
    text = spark.createDataFrame(lines, "value string")
    return text.select(F.from_json("value", schemas.RAW_EVENT).alias("e")).select("e.*")


def test_fork_resolution(spark):
    payloads = [
        "absent",
        {"forkee": None},
        {"forkee": {"fork": False, "parent": {"full_name": "up/stream"}}},
        {"forkee": {"fork": True}},
        {"forkee": {"fork": True, "parent": {}}},
        {"forkee": FORK},
    ]
    found = raw(spark, payloads).select("id", cleaning.canonical_repo().alias("repo"))
    assert [row.repo for row in found.orderBy("id").collect()] == ["me/copy"] * 5 + ["up/stream"]


def test_absent_repository_is_empty_text(spark):
    event = spark.createDataFrame([('{"id":"1","type":"WatchEvent"}',)], "value string")
    parsed = event.select(F.from_json("value", schemas.RAW_EVENT).alias("e")).select("e.*")
    row = cleaning.resolve_raw_events(parsed).first()
    assert (row.repo_name, row.actor, row.created_at) == ("", "unknown", "")


def test_irrelevant_types_are_dropped(spark):
    assert cleaning.resolve_raw_events(raw(spark, [{}], kind="PushEvent")).count() == 0
    assert cleaning.resolve_raw_events(raw(spark, [{}], kind="WatchEvent")).count() == 1


def test_messages_from_broken_or_partial_json(spark):
    whole = {"event_id": "1", "event_type": "WatchEvent", "repo_name": "a/b",
             "created_at": "2026-04-13T10:00:00Z"}
    lines = [
        json.dumps(whole),
        "{bad",
        json.dumps({k: v for k, v in whole.items() if k != "repo_name"}),
        json.dumps({**whole, "event_type": None}),
        json.dumps({**whole, "event_id": "2", "repo_name": ""}),
        json.dumps({**whole, "created_at": "yesterday"}),
    ]
    feed = spark.createDataFrame([(line,) for line in lines], "value string")
    valid = cleaning.valid_messages(parse_messages(feed))
    assert records(valid, "event_id", "repo_name") == [("1", "a/b"), ("2", "")]


def test_archive_events_need_a_repository_and_a_day(spark):
    data = spark.createDataFrame(
        [
            ("WatchEvent", ("a/b",), "2026-04-13T23:59:59Z"),
            ("WatchEvent", (None,), "2026-04-13T23:59:59Z"),
            ("ForkEvent", ("a/b",), "never"),
            ("PushEvent", ("a/b",), "2026-04-13T23:59:59Z"),
            (None, None, None),
        ],
        schemas.ARCHIVE_EVENT,
    )
    found = cleaning.archive_events(data).withColumn("day", F.col("day").cast("string"))
    assert records(found, "event_type", "repo_name", "day") == [("WatchEvent", "a/b", "2026-04-13")]


def test_distinct_events_keeps_one_row_per_id_whatever_the_order(spark):
    rows = [("1", "b"), ("2", "x"), ("1", "a"), ("2", "x"), (None, "n"), (None, "m")]
    wanted = [("1", "a"), ("2", "x"), (None, "m")]
    for data in (rows, rows[::-1]):
        found = cleaning.distinct_events(spark.createDataFrame(data, "event_id string, repo string"))
        assert records(found) == wanted


def test_distinct_events_collapses_copies_before_the_shuffle(spark):
    data = spark.range(1000).select(F.lit("hot").alias("event_id"), F.lit("a").alias("repo"))
    plan = cleaning.distinct_events(data)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
