from __future__ import annotations

import json
from pathlib import Path

from conftest import records
from test_tables import FIRST, SECOND, archive, metadata

from repopulse.plans import breakout, daily, dashboard
from repopulse.session import stream_session
from repopulse.sinks.daily import read_weekly
from repopulse.sources.feed import message_files
from repopulse.streaming import queries


def test_all_panels_from_the_tables_of_both_paths(spark, tables, folder):
    """Streams and the daily batch fill the tables; one refresh reads them all."""
    Path(f"{folder}/feed").mkdir(parents=True)
    lines = [
        json.dumps(
            {
                "event_id": str(i),
                "event_type": "WatchEvent",
                "repo_name": name,
                "language": language,
                "stars_count": i,
                "created_at": f"2026-04-13T10:0{i}:00Z",
            }
        )
        for i, (name, language) in enumerate([("a/b", "Go"), ("c/d", "Rust"), ("a/b", "Go")])
    ]
    Path(f"{folder}/feed/1.txt").write_text("\n".join(lines))
    feed = message_files(stream_session(spark, 2), f"{folder}/feed")
    queries.stream_live_metrics(feed, tables, f"{folder}/ck/m", every=None).awaitTermination()
    queries.stream_repos(feed, tables, f"{folder}/ck/r", every=None).awaitTermination()
    queries.stream_live_events(feed, tables, f"{folder}/ck/e", every=None).awaitTermination()
    daily.run_daily(spark, tables, archive(spark, FIRST))
    # The first source is asked by owner and name, so a bare name needs the second.
    tiers = [metadata(spark, []), metadata(spark, [("new", "Zig")])]
    daily.run_daily(spark, tables, archive(spark, SECOND), tiers)
    weekly = read_weekly(spark, tables)
    breakout.write_predictions(breakout.breakout_scores(spark, weekly, clusters=2), tables)

    panels = dashboard.dashboard(spark, tables)
    assert records(panels["trending_now"], "rank", "repo", "stars") == [(1, "a/b", 2), (2, "c/d", 1)]
    assert records(panels["rising_languages"], "language", "this_week", "last_week") == [
        ("Go", 1, 5), ("Rust", 4, 0), ("Zig", 1, 0),
    ]
    assert records(panels["activity_feed"], "timestamp", "repo") == [
        ("11:00:00", "a/b"), ("11:01:00", "c/d"), ("11:02:00", "a/b"),
    ]
    assert [row.stars_1 for row in panels["historical_trends"].orderBy("day").collect()] == [3, 5, 1]
    newest = {row.name: row.velocity + row.fork_velocity for row in weekly.collect() if row.day == "2026-04-13"}
    assert {row.repo: row.score for row in panels["trending_daily"].collect()} == newest
    assert records(panels["trending_now"], "repo", "is_new") == [("a/b", True), ("c/d", True)]
    assert records(panels["ai_insights"], "repo") == [("a/b",), ("c/d",), ("new",)]
