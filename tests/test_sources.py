from __future__ import annotations

import gzip
import json
from datetime import date
from pathlib import Path

import pytest
from conftest import records
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.sources import archive, feed, tables


def line(kind="WatchEvent", repo="a/b", at="2026-04-13T10:00:00Z"):
    return json.dumps({"type": kind, "repo": {"name": repo, "id": 3}, "created_at": at, "x": [1]})


def write_gz(path, lines):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")


def test_target_day_precedence():
    today = date(2026, 4, 14)
    assert archive.target_day("2026-04-01", today) == "2026-04-01"
    assert archive.target_day(" ", today) == "2026-04-13"
    assert archive.target_day(today=today) == "2026-04-13"


def test_whole_day_files_come_before_hourly_ones(spark, folder):
    for name in ("2026-04-13.json.gz", "2026-04-13-7.json.gz", "2026-04-14-7.json.gz", "2026-04-1.json.gz"):
        write_gz(f"{folder}/{name}", [line()])
    for hour in range(24):
        write_gz(f"{folder}/2026-04-15-{hour}.json.gz", [line()])
    days = [f"2026-04-1{d}" for d in (3, 4, 5, 6)]
    paths, incomplete = archive.archive_paths(spark, folder, days)
    names = [p.removeprefix(f"{folder}/") for p in paths]
    assert names[:2] == ["2026-04-13.json.gz", "2026-04-14-7.json.gz"] and len(names) == 26
    assert incomplete == ["2026-04-14", "2026-04-16"]
    assert archive.read_archive(spark, paths).count() == 26
    with pytest.raises(FileNotFoundError):
        archive.archive_paths(spark, f"{folder}/none", days)


def test_unreadable_lines_are_set_aside(spark, folder):
    write_gz(f"{folder}/2026-04-13.json.gz", [line(), "not json", line("ForkEvent")])
    found = archive.read_archive(spark, f"{folder}/2026-04-13.json.gz")
    assert records(archive.readable(found), "type") == [("ForkEvent",), ("WatchEvent",)]
    bad = archive.quarantined(found).first()
    assert bad.record == "not json" and bad.path.endswith("2026-04-13.json.gz")


def test_truncated_file_fails_unless_told_otherwise(spark, folder):
    path = f"{folder}/2026-04-13.json.gz"
    write_gz(path, [line(repo=f"a/{i * 7919 % 99991}") for i in range(50_000)])
    whole = Path(path).read_bytes()
    Path(path).write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        archive.readable(archive.read_archive(spark, path)).groupBy("repo.name").count().collect()
    rest = archive.readable(archive.read_archive(spark, path, skip_corrupt_files=True))
    assert 0 < len(records(rest, "type")) < 50_000


def paths(spark, *names):
    return spark.createDataFrame([(f"/archive/{name}",) for name in names], "path string")


def test_coverage_by_day_file_or_all_hours(spark):
    hourly = [f"2026-04-14-{hour}.json.gz" for hour in range(24)]
    found = paths(spark, "2026-04-13.json.gz", *hourly, "2026-04-15-3.json.gz", "2026-04-15.json")
    days = spark.createDataFrame([(f"2026-04-{d}",) for d in (13, 14, 15, 16)], "day string")
    coverage = archive.archive_coverage(found, days)
    assert records(coverage, "day", "whole_day", "complete", "missing_hours") == [
        ("2026-04-13", True, True, []),
        ("2026-04-14", False, True, []),
        ("2026-04-15", False, False, [h for h in range(24) if h != 3]),
        ("2026-04-16", False, False, list(range(24))),
    ]
    assert archive.missing_hours(coverage).count() == 47


def test_expiry_is_strict_and_keeps_undated_paths(spark):
    found = paths(spark, "2026-04-12.json.gz", "2026-04-13-4.json.gz", "2026-04-14.json.gz", "old.json.gz", "2020-01-01.txt")
    expired = archive.expired_files(found, "2026-05-13", retention_days=30)
    assert records(expired) == [("/archive/2026-04-12.json.gz", "2026-04-12")]


def test_listing_files(spark, folder):
    write_gz(f"{folder}/2026-04-13.json.gz", [line()])
    Path(f"{folder}/notes.txt").write_text("x")
    found = archive.list_files(spark, folder).select(F.element_at(F.split("path", "/"), -1))
    assert records(found) == [("2026-04-13.json.gz",)]


def test_raw_event_files(spark, folder):
    Path(folder).mkdir(parents=True)
    event = {"id": "1", "type": "ForkEvent", "repo": {"name": "a/b"}, "payload": {"forkee": {"fork": True}}}
    Path(f"{folder}/events.json").write_text(json.dumps(event) + "\n")
    row = feed.raw_event_files(spark, folder).first()
    assert row.payload.forkee.fork is True and row.actor is None
    assert feed.raw_event_files(spark, folder, stream=True).isStreaming


def test_topic_stream_needs_the_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        feed.topic_stream(spark, "localhost:9092", "events")


def test_scan_by_prefix_order_and_limit(spark):
    data = spark.createDataFrame([(k,) for k in ("b#1", "a#2", "a#1", "a#3")], "row_key string")
    keys = [row.row_key for row in tables.scan(data, 2, prefix="a#", latest_first=True).collect()]
    assert keys == ["a#3", "a#2"]
    assert tables.scan(data).count() == 4
    plan = tables.scan(data, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_newest_weekly_metrics_skips_rows_that_are_no_day_rows(spark):
    data = spark.createDataFrame([("2026-04-13#a",), ("last_day_data_a",)], "row_key string")
    assert records(tables.newest_weekly_metrics(data)) == [("2026-04-13#a",)]


def test_recent_days_widens_only_when_the_newest_day_is_short(spark, folder):
    data = spark.createDataFrame([("d1", 1), ("d2", 1), ("d2", 2)], "day string, v int")
    data.write.partitionBy("day").parquet(folder)
    schema = "v int, day string"
    assert tables.recent_days(spark, folder, schema, 2).count() == 2
    assert tables.recent_days(spark, folder, schema, 3).count() == 3
    assert tables.recent_days(spark, folder, schema, 9).count() == 3
    assert tables.recent_days(spark, f"{folder}/none", schema, 9).count() == 0


def test_reading_one_of_sixty_days_lists_only_its_files(spark, folder):
    days = spark.range(60).select(F.concat(F.lit("d"), F.lpad("id", 2, "0")).alias("day"), "id")
    days.repartition(3).write.partitionBy("day").parquet(folder)
    schema = "id long, day string"
    for found in (
        tables.read_days(spark, folder, schema, ["d07"]),
        tables.recent_days(spark, folder, schema, 1),
    ):
        assert found.count() == 1
        assert len(found.inputFiles()) == 1
    assert records(tables.read_days(spark, folder, schema, ["d07", "d99", "d58"])) == [(58, "d58"), (7, "d07")]


def test_tables_not_written_yet_read_as_empty(spark, tables):
    from repopulse.sources.tables import processed_days, read_table

    assert read_table(spark, tables.weekly_metrics, schemas.WEEKLY_METRICS, first=True).count() == 0
    with pytest.raises(AnalysisException):
        read_table(spark, tables.weekly_metrics, schemas.WEEKLY_METRICS)
    assert processed_days(spark, tables).count() == 0


def test_damage_names_the_files_that_were_cut_off(spark, folder):
    names = [f"{folder}/2026-04-13-{hour}.json.gz" for hour in range(4)]
    for name in names:
        write_gz(name, [line(repo=f"a/{i}") for i in range(3000)])
    Path(names[1]).write_bytes(Path(names[1]).read_bytes()[:-900])
    Path(names[2]).write_bytes(b"")
    with gzip.open(names[3], "wt") as out:
        out.write(line())
    found = {r["path"].split("-")[-1]: r for r in archive.damage(spark, names).collect()}
    assert {name: r["is_whole"] for name, r in found.items()} == {
        "0.json.gz": True, "1.json.gz": False, "2.json.gz": False, "3.json.gz": True,
    }
    assert {r["day"] for r in found.values()} == {"2026-04-13"}
    assert found["0.json.gz"]["lines"] == 3000 > found["1.json.gz"]["lines"]
    assert found["2.json.gz"]["lines"] == 0
