from __future__ import annotations

import random
from collections import defaultdict

import pytest
from conftest import records

from repopulse import schemas
from repopulse.plans import dashboard, panels


def live(spark, rows):
    """Rows of (window, name, language, stars)."""
    data = [
        (f"{window}#{name}#WatchEvent#{lang}", name, "WatchEvent", lang, stars, 0, 0, name, "w", 1, window)
        for window, name, lang, stars in rows
    ]
    return spark.createDataFrame(data, schemas.LIVE_METRICS)


def weekly(spark, rows):
    """Rows of (day, name, language, stars, velocity, fork_velocity)."""
    data = [
        (f"{day}#{name}", name, lang, name, stars, 0, vel, fork_vel, 1, 0, 0, day)
        for day, name, lang, stars, vel, fork_vel in rows
    ]
    return spark.createDataFrame(data, schemas.WEEKLY_METRICS)


def language_rows(spark, rows):
    return weekly(spark, [(day, f"r{i}", lang, stars, 0, 0) for i, (day, lang, stars) in enumerate(rows)])


def test_trending_ranks_all_rows_of_the_newest_window(spark):
    data = live(
        spark,
        [("10:00", "old/best", "C", 99), ("10:10", "a", "Go", 5), ("10:20", "a", "Rust", 3), ("10:20", "b", "Go", 5)],
    )
    assert records(panels.trending_now(data, limit=3)) == [(1, "b", "Go", 5), (2, "a", "Rust", 3)]
    assert records(panels.trending_window(data, limit=3)) == [(1, "b", "Go", 5), (2, "a", "Rust", 3)]
    assert records(panels.trending_window(data, nth=2)) == [(1, "a", "Go", 5)]
    assert records(panels.trending_window(data, nth=9)) == []


def test_new_entrants(spark):
    data = live(spark, [("10:00", "a", "C", 1), ("10:10", "a", "Go", 5), ("10:10", "b", "Go", 6)])
    now, before = panels.trending_window(data), panels.trending_window(data, nth=2)
    assert records(panels.new_entrants(now, before), "repo") == [("b",)]
    assert records(panels.with_new_flag(now, before), "repo", "is_new") == [("a", False), ("b", True)]


def test_the_best_of_many_is_found_wherever_its_key_sorts(spark):
    names = [f"org/r{i:04d}" for i in range(3000)]
    days = [("2026-04-13", n, "Go", 1, 10_000 if n == names[0] else i % 50, 0) for i, n in enumerate(names)]
    assert panels.trending_daily(weekly(spark, days), limit=1).first().repo == names[0]
    rows = [("10:00", n, "Go", 10_000 if n == names[0] else i % 50) for i, n in enumerate(names)]
    assert panels.trending_now(live(spark, rows), limit=1).first().repo == names[0]


def test_unknown_language_is_kept_only_when_alone(spark):
    alone = language_rows(spark, [("2026-04-13", "Unknown", 4), ("2026-04-13", " ", 1)])
    assert records(panels.rising_languages(alone), "language", "this_week") == [("Unknown", 5)]
    assert records(panels.language_totals(alone)) == [("Unknown", 5, 1)]
    assert records(panels.historical_long(alone), "language", "stars") == [("Unknown", 5)]
    mixed = language_rows(
        spark, [("2026-04-13", "Go", 1), ("2026-04-13", "", 9), ("2026-04-14", "Unknown", 9)]
    )
    assert records(panels.rising_languages(mixed), "language", "this_week", "last_week") == [("Go", 1, 0)]
    assert records(panels.language_totals(mixed)) == [("Go", 1, 1)]
    assert records(panels.historical_long(mixed), "day", "language", "stars") == [("2026-04-13", "Go", 1)]


def test_rising_languages_compares_the_newest_two_days(spark):
    data = language_rows(
        spark,
        [
            ("2026-04-10", "Go", 100),
            ("2026-04-12", "Go", 4),
            ("2026-04-12", "Gone", 9),
            ("2026-04-14", "Go", 8),
            ("2026-04-14", "New", 2),
            ("2026-04-14", "Zero", 0),
            ("junk", "Go", 50),
        ],
    )
    found = panels.rising_languages(data)
    assert records(found, "rank", "language", "this_week", "last_week", "this_pct", "last_pct") == [
        (1, "Go", 8, 4, 100.0, 50.0),
        (2, "New", 2, 0, 25.0, 1.5),
        (3, "Zero", 0, 0, 1.5, 1.5),
    ]


def brute_history(rows, limit=5):
    known = [r for r in rows if r[1] != "Unknown"] or rows
    totals = defaultdict(int)
    per_day = defaultdict(int)
    for day, lang, stars in known:
        totals[lang] += stars
        per_day[day, lang] += stars
    top = sorted(totals, key=lambda lang: (-totals[lang], lang))[:limit]
    days = {day for day, _, _ in known}
    return [(day, i, lang, per_day[day, lang]) for day in days for i, lang in enumerate(top, 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_historical_trends_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    names = ["Go", "C", "Rust", "Zig", "Perl", "Java", "Lua", "Unknown"]
    rows = [
        (f"2026-04-{rng.randint(10, 16)}", rng.choice(names), rng.randint(0, 9)) for _ in range(120)
    ]
    rows.append(("2026-04-30", "Tiny", 0))
    data = language_rows(spark, rows)
    wanted = sorted(brute_history(rows), key=repr)
    assert records(panels.historical_long(data), "day", "rank", "language", "stars") == wanted
    wide = panels.historical_wide(data)
    labels = wide.columns[1:]
    melted = [
        (row.day, i, label, row[label]) for row in wide.collect() for i, label in enumerate(labels, 1)
    ]
    assert sorted(melted, key=repr) == wanted


def test_history_with_fewer_languages_than_slots(spark):
    row = panels.historical_slots(language_rows(spark, [("2026-04-30", "Go", 3)])).first()
    assert (row.day, row.label, row.lang_1, row.stars_1) == ("2026-04-30", "30 Apr", "Go", 3)
    assert row.lang_2 is None and row.stars_2 == 0


def test_activity_feed(spark):
    data = spark.createDataFrame(
        [(f"202604132359{i:02d}#{i}#a/b#WatchEvent", "a/b", None, "Go", "a") for i in range(30)]
        + [("none#x#c/d#ForkEvent", None, "ForkEvent", "Go", "c")],
        schemas.LIVE_EVENTS,
    )
    found = records(panels.activity_feed(data, limit=2), "timestamp", "type", "repo")
    assert found == [("00:59:29", "Event", "a/b"), ("none", "ForkEvent", "")]


def test_trending_daily_takes_the_newest_day_and_breaks_ties(spark):
    data = weekly(
        spark,
        [
            ("2026-04-12", "old", "C", 1, 99, 0),
            ("2026-04-13", "a", "Go", 7, 3, 1),
            ("2026-04-13", "b", "Go", 7, 2, 2),
            ("2026-04-13", "c", None, 7, -5, 1),
        ],
    )
    shown = ("rank", "repo", "language", "score", "score_pct")
    assert records(panels.trending_daily(data), *shown) == [
        (1, "b", "Go", 4, 100.0),
        (2, "a", "Go", 4, 100.0),
        (3, "c", "Unknown", -4, 2.0),
    ]
    assert records(panels.trending_daily(data, limit=1), "repo") == [("b",)]


def test_ai_insights_by_probability_or_another_column(spark):
    data = spark.createDataFrame(
        [("a", 0.119, "x", 3.9), ("b", 0.9, None, -2.5), ("c", 0.5, "y", 0.0)], schemas.PREDICTIONS
    )
    assert records(panels.ai_insights(data, 2)) == [
        ("b", 0.9, 90, "Unknown", -2),
        ("c", 0.5, 50, "y", 0),
    ]
    assert records(panels.ai_insights(data, 1, order_by="predicted_growth"), "repo") == [("a",)]


def test_dashboard_over_tables_not_written_yet(spark, tables):
    shown = dashboard.dashboard(spark, tables)
    assert len(shown) == 6
    for rows in shown.values():
        assert rows.count() == 0
