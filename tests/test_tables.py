from __future__ import annotations

import gzip
import json
from functools import partial
from pathlib import Path

import pytest
from conftest import records
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.plans import daily
from repopulse.sinks import daily as daily_sinks
from repopulse.sinks import live
from repopulse.sources.tables import processed_days, read_table


def archive(spark, rows):
    """Rows of (day, repository, stars, forks)."""
    events = []
    for day, repo, stars, forks in rows:
        at = f"{day}T12:00:00Z"
        events += [("WatchEvent", (repo,), at)] * stars + [("ForkEvent", (repo,), at)] * forks
    return spark.createDataFrame(events, schemas.ARCHIVE_EVENT)


def metadata(spark, rows):
    return spark.createDataFrame([(name, lang, 1, 1, 1) for name, lang in rows], schemas.METADATA)


def velocities(spark, tables):
    return records(daily_sinks.read_weekly(spark, tables), "day", "name", "stars", "velocity", "fork_velocity")


FIRST = [("2026-04-10", "a/b", 3, 1), ("2026-04-10", "c/d", 2, 0), ("2026-04-11", "a/b", 5, 0)]
SECOND = [("2026-04-13", "a/b", 1, 2), ("2026-04-13", "c/d", 4, 1), ("2026-04-13", "new", 1, 0)]


def test_runs_day_by_day_equal_one_run_over_all(spark, tables, folder):
    from repopulse.sources.tables import Tables

    once = Tables(f"{folder}/once")
    assert daily.run_daily(spark, once, archive(spark, FIRST + SECOND))
    assert daily.run_daily(spark, tables, archive(spark, FIRST))
    assert daily.run_daily(spark, tables, archive(spark, FIRST + SECOND))
    assert velocities(spark, tables) == velocities(spark, once)
    assert records(daily_sinks.read_snapshot(spark, tables)) == records(
        daily_sinks.read_snapshot(spark, once)
    )
    assert records(processed_days(spark, tables)) == [("2026-04-10",), ("2026-04-11",), ("2026-04-13",)]


def test_without_carry_in_each_run_starts_from_zero(spark, tables):
    daily.run_daily(spark, tables, archive(spark, FIRST))
    daily.run_daily(spark, tables, archive(spark, SECOND), carry_in=False)
    assert ("2026-04-13", "a/b", 1, 1, 2) in velocities(spark, tables)


def test_processed_days_are_skipped(spark, tables):
    assert daily.run_daily(spark, tables, archive(spark, FIRST))
    before = velocities(spark, tables)
    assert not daily.run_daily(spark, tables, archive(spark, [("2026-04-10", "late", 9, 9)]))
    assert velocities(spark, tables) == before


def test_reprocessing_a_day_gives_the_same_rows(spark, tables):
    daily.run_daily(spark, tables, archive(spark, FIRST))
    daily.run_daily(spark, tables, archive(spark, SECOND))
    before, snapshot = velocities(spark, tables), records(daily_sinks.read_snapshot(spark, tables))
    assert daily.run_daily(spark, tables, archive(spark, SECOND), reprocess=True)
    assert velocities(spark, tables) == before
    assert records(daily_sinks.read_snapshot(spark, tables)) == snapshot
    assert processed_days(spark, tables).count() == 3


def test_incomplete_days_are_written_but_not_marked(spark, tables):
    incomplete = spark.createDataFrame([("2026-04-11",)], "day string")
    daily.run_daily(spark, tables, archive(spark, FIRST), incomplete_days=incomplete)
    assert records(processed_days(spark, tables)) == [("2026-04-10",)]
    assert daily.run_daily(spark, tables, archive(spark, [*FIRST, ("2026-04-11", "c/d", 2, 2)]))
    assert ("2026-04-11", "c/d", 2, 0, 2) in velocities(spark, tables)


def test_a_late_day_reaches_the_later_snapshots(spark, tables):
    daily.run_daily(spark, tables, archive(spark, FIRST))
    daily.run_daily(spark, tables, archive(spark, SECOND))
    late = [("2026-04-12", "c/d", 7, 0), ("2026-04-12", "only/late", 6, 0)]
    assert daily.run_daily(spark, tables, archive(spark, late))
    found = records(daily_sinks.read_snapshot(spark, tables), "name", "last_stars", "last_day")
    assert found == [
        ("a/b", 1, "2026-04-13"), ("c/d", 4, "2026-04-13"),
        ("new", 1, "2026-04-13"), ("only/late", 6, "2026-04-12"),
    ]
    daily.run_daily(spark, tables, archive(spark, [("2026-04-14", "only/late", 8, 0)]))
    assert ("2026-04-14", "only/late", 8, 2, 0) in velocities(spark, tables)


def test_snapshot_keeps_repositories_absent_on_the_last_day(spark, tables):
    daily.run_daily(spark, tables, archive(spark, FIRST))
    found = records(daily_sinks.read_snapshot(spark, tables), "name", "last_stars", "last_day")
    assert found == [("a/b", 5, "2026-04-11"), ("c/d", 2, "2026-04-10")]


def test_backfill_rewrites_only_days_that_change(spark, tables):
    rows = [("2026-04-10", "a/b", 1, 0), ("2026-04-11", "c/d", 1, 0), ("2026-04-12", "a/b", 1, 0)]
    daily.run_daily(spark, tables, archive(spark, rows), [metadata(spark, [("c/d", "Go")])])
    files = {p: p.stat().st_mtime_ns for p in Path(tables.weekly_metrics).glob("day=*/*.parquet")}
    daily.run_backfill(spark, tables, metadata(spark, [("a/b", "Rust")]))
    found = records(daily_sinks.read_weekly(spark, tables), "day", "name", "language")
    assert found == [("2026-04-10", "a/b", "Rust"), ("2026-04-11", "c/d", "Go"), ("2026-04-12", "a/b", "Rust")]
    kept = {p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]}
    assert kept == {p for p in files if "2026-04-11" in str(p)}


def test_run_from_files_quarantines_and_then_backfills(spark, tables, folder):
    events = [{"type": "WatchEvent", "repo": {"name": "a/b"}, "created_at": "2026-04-10T01:00:00Z"}]
    lines = [json.dumps(e) for e in events] + ["{broken", json.dumps({"type": "PushEvent"})]
    Path(folder).mkdir(parents=True)
    with gzip.open(f"{folder}/2026-04-10.json.gz", "wt") as out:
        out.write("\n".join(lines))
    # Hourly files beside the whole-day file are not counted again.
    with gzip.open(f"{folder}/2026-04-10-1.json.gz", "wt") as out:
        out.write("\n".join(lines))
    source = metadata(spark, [("a/b", "Zig")])
    arguments = {"quarantine": True, "metadata": source}
    assert daily.run_archive(spark, tables, folder, ["2026-04-10"], **arguments)
    assert records(spark.read.parquet(tables.quarantine), "record") == [("{broken",)]
    assert records(daily_sinks.read_weekly(spark, tables), "name", "language") == [("a/b", "Unknown")]
    assert not daily.run_archive(spark, tables, folder, ["2026-04-10"], metadata=source)
    assert records(daily_sinks.read_weekly(spark, tables), "name", "language") == [("a/b", "Zig")]


WINDOWS = (
    "window_start string, window_end string, repo_name string, event_type string, language string, "
    "stars_count bigint, forks_count bigint, watchers_count bigint, event_count bigint"
)


def windows(spark, rows):
    """Rows of (window, repository, language, events)."""
    data = [(w, w, repo, "WatchEvent", lang, n, None, 0, n) for w, repo, lang, n in rows]
    return spark.createDataFrame(data, WINDOWS)


BATCHES = [
    [("2026-04-13 10:00:00", "a/b", "Go", 1), ("2026-04-13 10:00:00", "a/b", "Unknown", 4)],
    [("2026-04-13 10:00:00", "a/b", "Go", 3), ("2026-04-13 10:10:00", "c/d", None, 1)],
    [("2026-04-14 00:00:00", "c/d", "C", 2)],
]
LATEST = [
    ("2026-04-13 10:00:00#a/b#WatchEvent#Go", 3, 0),
    ("2026-04-13 10:00:00#a/b#WatchEvent#Unknown", 4, 0),
    ("2026-04-13 10:10:00#c/d#WatchEvent#Unknown", 1, 0),
    ("2026-04-14 00:00:00#c/d#WatchEvent#C", 2, 0),
]


def write_batches(spark, tables):
    write = live.upsert_live_batch(tables)
    for number, rows in enumerate(BATCHES):
        write(windows(spark, rows), number)
    return write


def live_rows(spark, tables):
    return records(live.read_live_metrics(spark, tables), "row_key", "count", "forks")


def test_live_rows_show_the_newest_version(spark, tables):
    write_batches(spark, tables)
    assert live_rows(spark, tables) == LATEST


def test_repeating_a_batch_changes_nothing(spark, tables):
    write = write_batches(spark, tables)
    write(windows(spark, BATCHES[1]), 1)
    write(windows(spark, BATCHES[0]), 0)
    assert live_rows(spark, tables) == LATEST


def test_compaction_keeps_what_readers_see(spark, tables):
    write = live.upsert_live_batch(tables)
    write(windows(spark, BATCHES[0]), 0)
    live.compact_live_metrics(spark, tables)
    write(windows(spark, BATCHES[1]), 1)
    write(windows(spark, BATCHES[2]), 2)
    assert live_rows(spark, tables) == LATEST
    live.compact_live_metrics(spark, tables)
    assert live_rows(spark, tables) == LATEST
    history = spark.read.parquet(tables.live_history)
    assert history.count() == 4
    assert records(history.select("day").distinct().withColumn("day", F.col("day").cast("string"))) == [
        ("2026-04-13",), ("2026-04-14",),
    ]
    recent = live.recent_live_metrics(spark, tables, 1)
    assert records(recent, "window") == [("2026-04-14 00:00:00",)]
    assert live.recent_live_metrics(spark, tables, 2).count() == 4


def test_writing_days_again_replaces_them(spark, tables):
    rows = spark.createDataFrame(
        [("2026-04-10#a", "a", "Go", "a", 1, 1, 1, 1, 1, 0, 0, "2026-04-10")], schemas.WEEKLY_METRICS
    )
    days = ["2026-04-10"]
    daily_sinks.write_weekly(spark, rows, tables, days)
    nine = rows.withColumn("stars", F.lit(9).cast("bigint"))
    daily_sinks.write_weekly(spark, nine, tables, days)
    assert records(daily_sinks.read_language_days(spark, tables), "stars", "repos") == [(9, 1)]
    stored = read_table(spark, tables.weekly_metrics, schemas.WEEKLY_METRICS)
    assert records(stored, "day", "stars") == [("2026-04-10", 9)]


def one_event(name, time):
    return ("WatchEvent", (name,), time)


def raw_archive(spark, rows):
    return spark.createDataFrame(rows, schemas.ARCHIVE_EVENT)


def test_days_not_asked_for_are_put_aside(spark, tables):
    full = [one_event("a/b", "2026-04-12T01:00:00Z")] * 3 + [one_event("c/d", "2026-04-12T02:00:00Z")]
    daily.run_daily(spark, tables, raw_archive(spark, full), incomplete_days=spark.createDataFrame([("2026-04-12",)], "day string"))
    stray = [one_event("a/b", f"2026-04-1{d}T23:59:59Z") for d in (2, 3, 4)]
    for _ in range(2):
        daily.run_daily(spark, tables, raw_archive(spark, stray), days=["2026-04-13"], strays=True)
    stored = daily_sinks.read_weekly(spark, tables)
    # The stray of the stored day counts there, once; that of another day waits.
    assert records(stored, "day", "name", "stars", "velocity") == [
        ("2026-04-12", "a/b", 4, 4), ("2026-04-12", "c/d", 1, 1), ("2026-04-13", "a/b", 1, -3),
    ]
    assert records(processed_days(spark, tables), "day") == [("2026-04-13",)]
    aside = daily_sinks.read_strays(spark, tables)
    assert records(aside, "day", "repo_name", "source") == [
        ("2026-04-12", "a/b", "2026-04-13..2026-04-13"), ("2026-04-14", "a/b", "2026-04-13..2026-04-13"),
    ]
    # The day that came as a stray is still to be done, and has its stray then.
    assert daily.run_daily(spark, tables, raw_archive(spark, stray[2:] * 5), days=["2026-04-14"], strays=True)
    stored = daily_sinks.read_weekly(spark, tables).where("day = '2026-04-14'")
    assert records(stored, "name", "stars") == [("a/b", 6)]


def test_strays_of_finished_days_reach_them(spark, tables):
    daily.run_daily(spark, tables, raw_archive(spark, [one_event("a/b", "2026-04-12T01:00:00Z")] * 3))
    daily.run_daily(spark, tables, raw_archive(spark, [one_event("a/b", "2026-04-13T01:00:00Z")] * 2))
    mixed = [one_event("a/b", "2026-04-14T01:00:00Z")] * 9 + [
        one_event("a/b", "2026-04-12T02:00:00Z"), one_event("new", "2026-04-12T02:00:00Z"),
    ]
    for _ in range(2):
        daily.run_daily(spark, tables, raw_archive(spark, mixed), days=["2026-04-14"], reprocess=True, strays=True)
        assert velocities(spark, tables) == [
            ("2026-04-12", "a/b", 4, 4, 0), ("2026-04-12", "new", 1, 1, 0),
            ("2026-04-13", "a/b", 2, -2, 0), ("2026-04-14", "a/b", 9, 7, 0),
        ]
    # A repeated run without strays takes them back.
    daily.run_daily(spark, tables, raw_archive(spark, mixed[:9]), days=["2026-04-14"], reprocess=True, strays=True)
    assert daily_sinks.read_strays(spark, tables).count() == 0


def test_a_reprocessed_day_without_events_is_emptied(spark, tables):
    for day, n in (("2026-04-12", 3), ("2026-04-13", 5), ("2026-04-14", 4)):
        daily.run_daily(spark, tables, raw_archive(spark, [one_event("a/b", f"{day}T01:00:00Z")] * n))
    other = raw_archive(spark, [one_event("a/b", "2026-04-12T01:00:00Z")] * 2)
    daily.run_daily(spark, tables, other, days=["2026-04-12", "2026-04-13"], reprocess=True)
    assert velocities(spark, tables) == [("2026-04-12", "a/b", 2, 2, 0), ("2026-04-14", "a/b", 4, 2, 0)]
    assert records(daily_sinks.read_language_days(spark, tables), "day") == [("2026-04-12",), ("2026-04-14",)]


@pytest.mark.parametrize("fold_after", [0, 1, 99])
def test_snapshots_agree_however_often_they_are_folded(spark, tables, folder, monkeypatch, fold_after):
    """Days in and out of order, a day again, and a repository that is gone from its last day."""
    monkeypatch.setattr(daily, "update_snapshot", partial(daily_sinks.update_snapshot, fold_after=fold_after))
    days = [
        [("2026-04-10", "a/b", 3, 1), ("2026-04-10", "c/d", 2, 0)],
        [("2026-04-12", "a/b", 5, 0), ("2026-04-12", "e/f", 1, 0)],
        [("2026-04-11", "c/d", 7, 0), ("2026-04-11", "late", 6, 0)],
        [("2026-04-13", "late", 8, 0)],
        [("2026-04-12", "e/f", 2, 0)],
    ]
    for rows in days:
        daily.run_daily(spark, tables, archive(spark, rows), days=[rows[0][0]], reprocess=True)
    assert velocities(spark, tables) == [
        ("2026-04-10", "a/b", 3, 3, 1), ("2026-04-10", "c/d", 2, 2, 0),
        ("2026-04-11", "c/d", 7, 5, 0), ("2026-04-11", "late", 6, 6, 0),
        ("2026-04-12", "e/f", 2, 2, 0), ("2026-04-13", "late", 8, 2, 0),
    ]
    assert records(daily_sinks.read_snapshot(spark, tables), "name", "last_stars", "last_day") == [
        ("a/b", 3, "2026-04-10"), ("c/d", 7, "2026-04-11"), ("e/f", 2, "2026-04-12"), ("late", 8, "2026-04-13"),
    ]


def test_a_fold_writes_only_buckets_with_active_repositories(spark, tables):
    rows = [("2026-04-10", f"o/r{i}", 1, 0) for i in range(60)]
    daily.run_daily(spark, tables, archive(spark, rows))
    daily_sinks.fold_snapshot(spark, tables)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(tables.snapshots).glob("bucket=*/*.parquet")}
    before = files()
    daily.run_daily(spark, tables, archive(spark, [("2026-04-11", "o/r7", 2, 0)]))
    # One more day is left to the daily rows, so nothing at all is written for it.
    assert files() == before
    daily_sinks.fold_snapshot(spark, tables)
    assert len({p.parent for p in before}) > 10
    assert len({p.parent for p in files() if p not in before}) == 1
    assert ("o/r7", 2) in records(daily_sinks.read_snapshot(spark, tables), "name", "last_stars")


def test_a_fold_that_was_cut_off_is_done_again(spark, tables, monkeypatch):
    daily.run_daily(spark, tables, archive(spark, FIRST))

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(daily_sinks, "replace_partitions", broken)
        with pytest.raises(OSError):
            daily_sinks.fold_snapshot(spark, tables)
    daily.run_daily(spark, tables, archive(spark, SECOND))
    assert ("2026-04-13", "a/b", 1, -4, 2) in velocities(spark, tables)
    assert records(daily_sinks.read_snapshot(spark, tables), "name", "last_stars") == [("a/b", 1), ("c/d", 4), ("new", 1)]


def test_late_days_read_only_their_repositories(spark, tables):
    """The plan of a late day's refresh joins the days since with its names alone."""
    daily.run_daily(spark, tables, archive(spark, FIRST + SECOND))
    daily_sinks.fold_snapshot(spark, tables)
    names = spark.createDataFrame([("c/d",)], "name string")
    before = daily_sinks.last_days_before(spark, tables, "2026-04-12", names)
    assert records(before, "name", "last_stars", "last_day") == [("c/d", 2, "2026-04-10")]
    assert before._jdf.queryExecution().executedPlan().toString().count("LeftSemi") >= 2
    assert not [f for f in before.inputFiles() if "2026-04-13" in f]


def test_a_missing_archive_folder_is_an_error(spark, tables, folder):
    with pytest.raises(FileNotFoundError):
        daily.run_archive(spark, tables, f"{folder}/mistyped", ["2026-04-10"])
    Path(folder).mkdir(parents=True)
    assert not daily.run_archive(spark, tables, folder, ["2026-04-10"])


def test_a_late_day_refreshes_the_velocity_of_the_next_one(spark, tables):
    stars = lambda day, n: [one_event("a/b", f"2026-04-{day}T01:00:00Z")] * n
    daily.run_daily(spark, tables, raw_archive(spark, stars(10, 5) + stars(12, 9)))
    daily.run_daily(spark, tables, raw_archive(spark, stars(11, 8)))
    stored = daily_sinks.read_weekly(spark, tables)
    assert records(stored, "day", "velocity") == [("2026-04-10", 5), ("2026-04-11", 3), ("2026-04-12", 1)]
    assert records(daily_sinks.read_snapshot(spark, tables), "last_stars", "last_day") == [(9, "2026-04-12")]


def test_an_incomplete_day_is_written_but_not_marked(spark, tables, folder):
    Path(folder).mkdir(parents=True)
    line = json.dumps({"type": "WatchEvent", "repo": {"name": "a/b"}, "created_at": "2026-04-10T01:00:00Z"})
    with gzip.open(f"{folder}/2026-04-10-1.json.gz", "wt") as out:
        out.write(line + "\n{broken")
    for _ in range(2):
        assert daily.run_archive(spark, tables, folder, ["2026-04-10"], quarantine=True)
    # The same bad line twice is one row.
    assert records(spark.read.parquet(tables.quarantine), "record") == [("{broken",)]
    assert daily_sinks.read_weekly(spark, tables).count() == 1


def test_a_damaged_day_is_counted_listed_and_not_marked(spark, tables, folder):
    Path(folder).mkdir(parents=True)
    lines = [json.dumps({"type": "WatchEvent", "repo": {"name": f"a/{i}"}, "created_at": "2026-04-10T01:00:00Z"}) for i in range(5000)]
    whole, cut = f"{folder}/2026-04-09.json.gz", f"{folder}/2026-04-10.json.gz"
    for name, day in ((whole, "09"), (cut, "10")):
        with gzip.open(name, "wt") as out:
            out.write("\n".join(lines).replace("04-10", f"04-{day}") + "\n")
    Path(cut).write_bytes(Path(cut).read_bytes()[:-2000])
    days = ["2026-04-09", "2026-04-10"]
    assert daily.run_archive(spark, tables, folder, days, skip_corrupt_files=True)
    assert records(processed_days(spark, tables)) == [("2026-04-09",)]
    broken = spark.read.parquet(tables.damaged_files).collect()
    assert [(r["day"].isoformat() if hasattr(r["day"], "isoformat") else r["day"], r["is_whole"]) for r in broken] == [("2026-04-10", False)]
    stored = {r["day"]: r["n"] for r in daily_sinks.read_weekly(spark, tables).groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert stored["2026-04-09"] == 5000 and 0 < stored["2026-04-10"] < 5000
    # The whole file, once it is there, replaces the day and clears the list.
    with gzip.open(cut, "wt") as out:
        out.write("\n".join(lines) + "\n")
    assert daily.run_archive(spark, tables, folder, days, skip_corrupt_files=True)
    assert processed_days(spark, tables).count() == 2
    assert not list(Path(tables.damaged_files).glob("day=*"))


def test_sketches_of_days_merge_to_distinct_repositories(spark, tables):
    from repopulse.operators.metrics import merged_distinct_repos

    rows = [(f"2026-04-{d}", f"o/r{i}", 1, 0) for d in (10, 11, 12) for i in range(d, 60)]
    daily.run_daily(spark, tables, archive(spark, rows))
    rollup = daily_sinks.read_language_days(spark, tables)
    assert records(merged_distinct_repos(rollup)) == [("Unknown", 50)]
    assert records(merged_distinct_repos(rollup.where("day > '2026-04-11'"))) == [("Unknown", 48)]
