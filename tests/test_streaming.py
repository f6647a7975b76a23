from __future__ import annotations

import json
import os
import time
from pathlib import Path

import pytest
from conftest import records
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators.metrics import windowed_activity
from repopulse.operators.cleaning import valid_messages
from repopulse.session import stream_session
from repopulse.sinks import live
from repopulse.sources.feed import message_files, parse_messages, raw_event_files
from repopulse.sources.tables import Tables
from repopulse.streaming import queries


def message(event_id, at, repo="a/b", kind="WatchEvent", language="Go", stars=1):
    return json.dumps(
        {
            "event_id": str(event_id),
            "event_type": kind,
            "repo_name": repo,
            "actor": "me",
            "language": language,
            "stars_count": stars,
            "forks_count": 1,
            "watchers_count": 1,
            "created_at": f"2026-04-13T{at}Z",
        }
    )


class Feed:
    """A folder whose files become one micro-batch each, oldest first."""

    def __init__(self, folder):
        self.path = Path(folder) / "feed"
        self.path.mkdir(parents=True)
        self.files = 0

    def add(self, *lines):
        self.files += 1
        path = self.path / f"{self.files:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))


@pytest.fixture
def feed(folder):
    return Feed(folder)


@pytest.fixture
def session(spark):
    return stream_session(spark, state_partitions=2)


def run_metrics(session, feed, tables, folder, **windows):
    """Process all new files, one per micro-batch; returns the progress of each."""
    source = message_files(session, str(feed.path), maxFilesPerTrigger=1)
    query = queries.stream_live_metrics(source, tables, f"{folder}/metrics", every=None, **windows)
    query.awaitTermination()
    return query.recentProgress


def counts(spark, tables):
    return records(live.read_live_metrics(spark, tables), "window", "name", "language", "count")


def test_late_events_count_until_their_window_has_closed(spark, session, feed, tables, folder):
    feed.add(message(1, "10:31:00"))
    feed.add(message(2, "10:32:00"), message(3, "10:02:00"))
    feed.add(message(4, "10:33:00"), message(5, "10:03:00"), message(6, "10:22:00"))
    progress = run_metrics(session, feed, tables, folder)
    assert len(progress) == 3
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress]
    assert dropped == [0, 0, 1]
    assert [(w[11:16], n) for w, _, _, n in counts(spark, tables)] == [
        ("10:00", 1), ("10:20", 1), ("10:30", 3),
    ]


def test_rows_dropped_as_late_are_reported(session, feed, tables, folder):
    feed.add(message(1, "10:31:00"))
    feed.add(message(2, "10:32:00"))
    feed.add(message(3, "10:33:00"), message(4, "10:03:00"))
    source = message_files(session, str(feed.path), maxFilesPerTrigger=1)
    query = queries.stream_live_metrics(source, tables, f"{folder}/metrics", every=None)
    query.awaitTermination()
    report = queries.lateness_report(query)
    assert [(r["batch_id"], r["rows"], r["dropped"]) for r in report] == [(0, 1, 0), (1, 1, 0), (2, 2, 1)]
    assert report[-1]["watermark"].startswith("2026-04-13T10:27")


def test_state_carries_over_batches_and_restarts(spark, session, feed, tables, folder):
    feed.add(message(1, "10:31:00", stars=5), message(2, "10:32:00", language="Unknown"))
    run_metrics(session, feed, tables, folder)
    feed.add(message(3, "10:33:00", stars=2))
    run_metrics(session, feed, tables, folder)
    found = records(live.read_live_metrics(spark, tables), "language", "count", "stars")
    assert found == [("Go", 2, 5), ("Unknown", 1, 1)]


def test_a_new_checkpoint_never_touches_earlier_batches(spark, session, feed, tables, folder):
    feed.add(message(1, "10:31:00"), message(2, "11:31:00", repo="c/d"))
    run_metrics(session, feed, tables, folder)
    feed.add(message(3, "10:32:00"), message(4, "12:00:00", repo="e/f"))
    source = message_files(session, f"{feed.path}/002.{{txt}}")
    time.sleep(1.1)
    queries.stream_live_metrics(source, tables, f"{folder}/anew", every=None).awaitTermination()
    assert [(name, n) for _, name, _, n in counts(spark, tables)] == [("a/b", 1), ("c/d", 1), ("e/f", 1)]


def test_failing_sink_stops_the_stream_and_the_batch_is_repeated(
    spark, session, feed, tables, folder, monkeypatch
):
    feed.add(message(1, "10:31:00"))

    write_batch = live.write_batch

    def broken(*given):
        write_batch(*given)
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(live, "write_batch", broken)
        with pytest.raises(Exception, match="no space"):
            run_metrics(session, feed, tables, folder)
    assert [n for *_, n in counts(spark, tables)] == [1]
    feed.add(message(2, "10:32:00"))
    run_metrics(session, feed, tables, folder)
    assert [n for *_, n in counts(spark, tables)] == [2]
    # The repeated batch has replaced what its first try wrote.
    logged = spark.read.parquet(tables.live_metrics)
    assert records(logged, "batch_id", "count") == [(0, 1), (1, 2)]


@pytest.mark.parametrize("spread", [True, False])
def test_duplicates_within_and_across_batches_count_once(
    spark, session, feed, tables, folder, spread
):
    feed.add(*[message(1, "10:31:00")] * 3, message(2, "10:32:00"))
    feed.add(message(1, "10:31:00"), message(3, "10:33:00"))
    run_metrics(session, feed, tables, folder, drop_duplicates=True, spread_copies=spread)
    assert [n for *_, n in counts(spark, tables)] == [3]


def test_duplicates_beyond_the_delay_are_not_recognised(spark, session, feed, tables, folder):
    feed.add(message(1, "10:31:00"))
    feed.add(message(2, "11:31:00"))
    feed.add(message(3, "11:41:00"))
    feed.add(message(1, "11:42:00"))
    run_metrics(session, feed, tables, folder, drop_duplicates=True)
    assert sum(n for *_, n in counts(spark, tables)) == 4


def test_one_pass_of_the_stream_equals_the_batch(spark, session, feed, tables, folder):
    lines = [
        message(i, f"{10 + i % 3}:{i % 60:02d}:00", repo="hot" if i % 3 else f"r{i % 7}", stars=i % 11)
        for i in range(300)
    ]
    feed.add(*lines, "{bad", "")
    run_metrics(session, feed, tables, folder)
    static = message_files(spark, str(feed.path), stream=False)
    batch = windowed_activity(valid_messages(parse_messages(static)))
    columns = ("window_start", "repo_name", "language", "event_count")
    assert counts(spark, tables) == records(batch, *columns)


def test_live_events_keep_every_valid_message_once(spark, session, feed, tables, folder):
    for restart in range(2):
        feed.add(message(restart, "10:31:00"), message(f"x{restart}", "10:32:00", language=""), "{bad")
        source = message_files(session, str(feed.path))
        queries.stream_live_events(source, tables, f"{folder}/feed-ck", every=None).awaitTermination()
    found = records(live.read_live_events(spark, tables), "row_key", "language", "day")
    assert found == [
        ("20260413103100#0#a/b#WatchEvent", "Go", "2026-04-13"),
        ("20260413103100#1#a/b#WatchEvent", "Go", "2026-04-13"),
        ("20260413103200#x0#a/b#WatchEvent", "Unknown", "2026-04-13"),
        ("20260413103200#x1#a/b#WatchEvent", "Unknown", "2026-04-13"),
    ]


def raw_event(event_id, kind="WatchEvent", at="2026-04-13T10:31:00Z", payload=None):
    return json.dumps(
        {
            "id": str(event_id),
            "type": kind,
            "repo": {"name": "me/copy"},
            "actor": {"login": "me"},
            "created_at": at,
            "payload": payload or {},
        }
    )


@pytest.mark.parametrize("spread", [True, False])
def test_publishing_cleans_resolves_and_enriches(spark, session, feed, tables, folder, spread):
    fork = {"forkee": {"fork": True, "parent": {"full_name": "up/stream"}}}
    feed.add(raw_event(1), raw_event(1), raw_event(2, "ForkEvent", payload=fork))
    feed.add(raw_event(1), raw_event(3, "PushEvent"), raw_event(4, at="never"))
    known = spark.createDataFrame([("up/stream", "Go", 7, 8, 9)], schemas.METADATA)
    raw = raw_event_files(session, str(feed.path), stream=True, maxFilesPerTrigger=1)
    queries.publish_messages(
        raw, known, tables, f"{folder}/publish", every=None, spread_copies=spread
    ).awaitTermination()
    published = parse_messages(spark.read.text(tables.messages))
    columns = ("event_id", "repo_name", "language", "stars_count", "watchers_count")
    assert records(published, *columns) == [
        ("1", "me/copy", "Unknown", 0, 0),
        ("2", "up/stream", "Go", 7, 9),
    ]
    queries.keep_unreadable(raw, tables, f"{folder}/unreadable", every=None).awaitTermination()
    assert records(spark.read.parquet(tables.unreadable), "event_id", "created_at") == [("4", "never")]


def test_late_events_are_published_while_ids_are_remembered(spark, session, feed, tables, folder):
    feed.add(raw_event(1, at="2026-04-13T10:31:00Z"))
    feed.add(raw_event(2, at="2026-04-13T10:40:00Z"))
    feed.add(raw_event(3, at="2026-04-13T10:41:00Z"), raw_event(4, at="2026-04-13T10:22:00Z"))
    feed.add(raw_event(4, at="2026-04-13T10:22:00Z"), raw_event(1, at="2026-04-13T10:31:00Z"))
    known = spark.createDataFrame([], schemas.METADATA)
    raw = raw_event_files(session, str(feed.path), stream=True, maxFilesPerTrigger=1)
    queries.publish_messages(raw, known, tables, f"{folder}/publish", every=None).awaitTermination()
    published = parse_messages(spark.read.text(tables.messages))
    assert records(published, "event_id") == [("1",), ("2",), ("3",), ("4",)]


def test_published_messages_feed_the_windows(spark, session, feed, tables, folder):
    feed.add(raw_event(1), raw_event(1), raw_event(2))
    known = spark.createDataFrame([("me/copy", "Go", 7, 8, 9)], schemas.METADATA)
    raw = raw_event_files(session, str(feed.path), stream=True)
    queries.publish_messages(raw, known, tables, f"{folder}/publish", every=None).awaitTermination()
    source = message_files(session, tables.messages)
    queries.stream_live_metrics(source, tables, f"{folder}/metrics", every=None).awaitTermination()
    found = records(live.read_live_metrics(spark, tables), "name", "language", "stars", "count")
    assert found == [("me/copy", "Go", 7, 2)]


def test_live_run_surfaces_a_failure_of_either_stream(spark, session, feed, folder, monkeypatch):
    feed.add(message(1, "10:31:00"))
    tables = Tables(f"{folder}/tables")

    def broken(*_):
        raise OSError("sink is gone")

    names = {"live-metrics", "live-repos", "live-events"}
    monkeypatch.setattr(live, "write_batch", broken)
    with pytest.raises(Exception, match="sink is gone"):
        queries.run_live(session, message_files(session, str(feed.path)), tables, f"{folder}/ck")
    assert session.streams.active == []
    assert {p.name for p in Path(f"{folder}/ck").iterdir()} == names


def test_live_run_stops_with_its_publishing_stream(spark, session, feed, folder, monkeypatch):
    tables = Tables(f"{folder}/tables")
    Path(f"{folder}/raw").mkdir(parents=True)
    Path(f"{folder}/raw/1.json").write_text(raw_event(1) + "\n")

    def broken(*_):
        raise OSError("topic is gone")

    monkeypatch.setattr("repopulse.sinks.live.message_values", broken)
    raw = raw_event_files(session, f"{folder}/raw", stream=True)
    known = spark.createDataFrame([], schemas.METADATA)
    with pytest.raises(Exception, match="topic is gone"):
        queries.run_live(
            session, message_files(session, str(feed.path)), tables, f"{folder}/ck", raw, known
        )
    assert session.streams.active == []
    assert "unreadable" in {p.name for p in Path(f"{folder}/ck").iterdir()}


def test_windows_of_another_width(spark, session, feed, tables, folder):
    feed.add(message(1, "10:31:00"), message(2, "10:36:00"))
    run_metrics(session, feed, tables, folder, width="5 minutes", delay="1 minute")
    assert [w[11:16] for w, *_ in counts(spark, tables)] == ["10:30", "10:35"]
    assert live.read_live_metrics(spark, tables).where(F.col("week") == "2026-04-13 00:00:00").count() == 2


def test_a_new_checkpoint_adds_to_the_feed_and_a_repeated_batch_replaces_itself(
    spark, session, feed, tables, folder
):
    feed.add(message(1, "10:31:00"))
    source = lambda: message_files(session, str(feed.path))
    queries.stream_live_events(source(), tables, f"{folder}/one", every=None).awaitTermination()
    feed.add(message(2, "10:32:00"), message(3, "10:33:00"))
    queries.stream_live_events(source(), tables, f"{folder}/two", every=None).awaitTermination()
    ids = lambda: sorted(row.row_key.split("#")[1] for row in live.read_live_events(spark, tables).collect())
    assert ids() == ["1", "1", "2", "3"]
    batch = parse_messages(message_files(session, str(feed.path), stream=False))
    for _ in range(2):
        live.append_events(tables)(batch, 7)
    assert ids() == ["1", "1", "1", "2", "2", "3", "3"]


def test_starts_are_numbered_by_what_is_stored(spark, tables):
    assert [live.next_start(spark, tables) for _ in range(3)] == [1, 2, 3]


def run_repos(session, feed, tables, checkpoint, **options):
    source = message_files(session, str(feed.path), maxFilesPerTrigger=1)
    queries.stream_repos(source, tables, checkpoint, every=None, **options).awaitTermination()


def test_two_starts_at_once_get_different_numbers(spark, tables, monkeypatch):
    """The other host creates its file after this one has listed the names."""
    assert live.next_start(spark, tables) == 1
    monkeypatch.setattr("repopulse.session.folder_names", lambda *_: [])
    assert live.next_start(spark, tables) == 2


@pytest.mark.parametrize("spread", [False, True])
def test_a_repository_is_logged_once_over_batches_and_restarts(spark, session, feed, tables, folder, spread):
    known = lambda: records(live.read_repos(spark, tables), "full_name", "language")
    feed.add(message(1, "10:31:00"), message(2, "10:32:00"), message(3, "10:33:00", repo="c/d", language="C"))
    feed.add(message(4, "10:34:00"), message(5, "10:35:00", repo="e/f", language="Zig"))
    run_repos(session, feed, tables, f"{folder}/repos", spread_copies=spread)
    feed.add(message(6, "10:36:00", language="Rust"), message(7, "10:37:00", repo="g/h"))
    run_repos(session, feed, tables, f"{folder}/repos", spread_copies=spread)
    logged = spark.read.parquet(tables.repos)
    wanted = [("a/b", "Go"), ("a/b", "Rust"), ("c/d", "C"), ("e/f", "Zig"), ("g/h", "Go")]
    assert records(logged, "full_name", "language") == wanted
    first = [pair for pair in wanted if pair != ("a/b", "Rust")]
    assert known() == first

    folded = live.compact_repos(spark, tables, "1")
    assert known() == first
    feed.add(message(8, "10:38:00", repo="i/j"))
    run_repos(session, feed, tables, f"{folder}/repos", spread_copies=spread)
    live.remove_folded(spark, tables, folded)
    first.append(("i/j", "Go"))
    assert known() == first
    assert spark.read.parquet(tables.repos).count() == 1
    live.remove_folded(spark, tables, live.compact_repos(spark, tables, "2"))
    assert known() == first
    assert [p.name for p in Path(tables.repos_folded).iterdir() if p.is_dir()] == ["run=2"]


def test_folded_live_batches_can_be_removed(spark, session, feed, tables, folder):
    feed.add(message(1, "10:31:00"))
    feed.add(message(2, "10:32:00"), message(3, "11:32:00", repo="c/d"))
    run_metrics(session, feed, tables, folder)
    before = counts(spark, tables)
    folded = live.compact_live_metrics(spark, tables, ["2026-04-13"])
    assert len(folded) == 2 and counts(spark, tables) == before
    feed.add(message(4, "11:33:00", repo="c/d"))
    run_metrics(session, feed, tables, folder)
    live.remove_folded(spark, tables, folded)
    assert [(name, n) for _, name, _, n in counts(spark, tables)] == [("a/b", 2), ("c/d", 2)]
    assert spark.read.parquet(tables.live_metrics).count() == 1
    assert live.compact_live_metrics(spark, tables, ["2026-04-12"]) == []
    live.expire_live_days(spark, tables, "2026-04-14", keep_live=1)
    assert counts(spark, tables) == []
