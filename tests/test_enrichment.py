from __future__ import annotations

from conftest import records
from repopulse import schemas
from repopulse.operators import enrichment


def repos(spark, rows):
    return spark.createDataFrame([(name, name, lang) for name, lang in rows], schemas.REPOS)


def metadata(spark, rows):
    return spark.createDataFrame([(*row, 0) for row in rows], schemas.METADATA)


def named(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "repo_name string")


def test_metadata_misses_become_defaults(spark):
    messages = spark.createDataFrame([("1", "a/b"), ("2", "c/d"), ("3", "e/f")], "event_id string, repo_name string")
    known = metadata(spark, [("a/b", "Go", 5, 2), ("e/f", None, None, 1)])
    found = enrichment.attach_metadata(messages, known)
    columns = ("event_id", "language", "stars_count", "forks_count", "watchers_count")
    assert records(found, *columns) == [
        ("1", "Go", 5, 2, 0),
        ("2", "Unknown", 0, 0, 0),
        ("3", "Unknown", 0, 1, 0),
    ]


def test_lookup_ignores_unknown_and_blank(spark):
    table = repos(spark, [("a/b", "Go"), ("c/d", "Unknown"), ("e/f", " "), ("g/h", None)])
    assert records(enrichment.language_lookup(table)) == [("a/b", "Go")]


def test_first_source_with_the_repository_decides(spark):
    dimension = repos(spark, [("dim/known", "Go"), ("dim/unknown", "Unknown")])
    first = metadata(
        spark,
        [("dim/known", "C", 9, 9), ("dim/unknown", "Rust", 1, 2), ("t1/nolang", None, 3, 4), ("noowner", "C", 7, 7)],
    )
    second = metadata(spark, [("t1/nolang", "Java", 8, 8), ("t2/only", "Perl", 5, 6), ("noowner", "Zig", 1, 1)])
    names = named(spark, "dim/known", "dim/unknown", "t1/nolang", "t2/only", "noowner", "none/at-all")
    assert records(enrichment.enrich_repos(names, dimension, [first, second])) == [
        ("dim/known", "Go", 0, 0),
        ("dim/unknown", "Rust", 1, 2),
        ("none/at-all", "Unknown", 0, 0),
        ("noowner", "Zig", 1, 1),
        ("t1/nolang", "Unknown", 3, 4),
        ("t2/only", "Perl", 5, 6),
    ]


def test_counts_for_dimension_hits_on_request(spark):
    dimension = repos(spark, [("dim/known", "Go")])
    first = metadata(spark, [("dim/known", "C", 9, 8)])
    names = named(spark, "dim/known")
    found = enrichment.enrich_repos(names, dimension, [first], first_known_counts=True)
    assert records(found) == [("dim/known", "Go", 9, 8)]


def test_enrichment_without_any_tier(spark):
    found = enrichment.enrich_repos(named(spark, "a/b"), repos(spark, []))
    assert records(found) == [("a/b", "Unknown", 0, 0)]


def live(spark, rows):
    return spark.createDataFrame(rows, "name string, window string, event_type string, language string")


def test_first_language_sticks(spark):
    first = enrichment.first_seen_repos(
        live(spark, [("a/b", "10:10", "WatchEvent", "Go"), ("a/b", "10:00", "WatchEvent", "Unknown")])
    )
    assert records(first) == [("a%2Fb", "a/b", "Unknown")]
    later = enrichment.first_seen_repos(
        live(spark, [("a/b", "11:00", "WatchEvent", "Go"), ("c d", "11:00", "ForkEvent", "C")])
    )
    assert records(enrichment.absent_repos(later, first)) == [("c%20d", "c d", "C")]


def weekly(spark, rows):
    data = [(f"{day}#{name}", cell, lang, day) for day, name, cell, lang in rows]
    return spark.createDataFrame(data, "row_key string, name string, language string, day string")


def test_backfill_fills_only_what_is_unknown_and_found(spark):
    table = weekly(
        spark,
        [
            ("2026-04-13", "a/b", "a/b", "Unknown"),
            ("2026-04-13", "c/d", "c/d", ""),
            ("2026-04-13", "e/f", "", None),
            ("2026-04-13", "g/h", "g/h", "Go"),
            ("2026-04-13", "i/j", "i/j", "Unknown"),
        ],
    )
    dimension = repos(spark, [("a/b", "Rust"), ("g/h", "Perl")])
    source = metadata(spark, [("a/b", "C", 0, 0), ("c/d", "Java", 0, 0), ("e/f", "Zig", 0, 0), ("i/j", "Unknown", 0, 0)])
    updates = enrichment.language_updates(table, dimension, source)
    filled = enrichment.with_languages(table, updates)
    assert records(filled, "row_key", "language") == [
        ("2026-04-13#a/b", "Rust"),
        ("2026-04-13#c/d", "Java"),
        ("2026-04-13#e/f", "Zig"),
        ("2026-04-13#g/h", "Go"),
        ("2026-04-13#i/j", "Unknown"),
    ]


def test_backfill_takes_every_row_without_a_language(spark):
    table = weekly(spark, [("2026-04-13", n, n, lang) for n, lang in (("a", "Go"), ("b", None), ("c", None))])
    assert records(enrichment.backfill_candidates(table), "name") == [("b",), ("c",)]
