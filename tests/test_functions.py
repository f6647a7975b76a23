from __future__ import annotations

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from repopulse.functions import numbers, text, times


def values(spark, expression, inputs, kind="string"):
    """The expression over column `v`, in the order of the inputs."""
    data = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    shown = data.select("i", expression(F.col("v")).alias("out")).orderBy("i")
    return [row.out for row in shown.collect()]


def test_stream_time_accepts_only_whole_seconds_in_utc(spark):
    inputs = [
        "2026-04-13T10:24:59Z",
        "2026-04-13T10:24:59.123Z",
        "2026-04-13T10:24:59+02:00",
        "bad",
        "",
        None,
    ]
    shown = values(spark, lambda c: times.stream_time(c).cast("string"), inputs)
    assert shown == ["2026-04-13 10:24:59", None, None, None, None, None]


def test_archive_time_accepts_fractions_and_offsets(spark):
    inputs = ["2026-04-13T10:24:59.123Z", "2026-04-13T10:24:59+02:00", "bad", None]
    shown = values(spark, lambda c: times.archive_time(c).cast("string"), inputs)
    assert shown == ["2026-04-13 10:24:59.123", "2026-04-13 08:24:59", None, None]


def test_day_text_is_the_utc_day(spark):
    inputs = ["2026-04-13T23:30:00-02:00", "2026-04-13T00:00:00Z"]
    shown = values(spark, lambda c: times.day_text(times.archive_time(c)), inputs)
    assert shown == ["2026-04-14", "2026-04-13"]


def test_parsed_day_falls_back_to_the_week_column(spark):
    data = spark.createDataFrame(
        [("2026-04-13", "2026-01-01"), (None, "2026-01-01"), ("junk", None)], "day string, week string"
    )
    shown = [
        str(row[0])
        for row in data.select(times.parsed_day(F.col("day"), F.col("week"))).collect()
    ]
    assert shown == ["2026-04-13", "2026-01-01", "None"]


def test_week_key_is_monday_or_unknown(spark):
    inputs = ["2026-04-15 10:20:00", "2026-04-13 00:00:00", "2026-04-19 23:50:00", "junk", None]
    monday = "2026-04-13 00:00:00"
    assert values(spark, times.week_key, inputs) == [monday, monday, monday, "unknown", "unknown"]


def test_compact_key(spark):
    shown = values(
        spark, lambda c: times.compact_key(times.stream_time(c)), ["2026-04-13T10:24:59Z", None]
    )
    assert shown == ["20260413102459", "none"]


def test_clock_label_shifts_slices_or_shows_raw(spark):
    inputs = ["20260413233000", "20269913102459", "none", "", None]
    assert values(spark, times.clock_label, inputs) == ["00:30:00", "10:24:59", "none", "", None]
    shifted = values(spark, lambda c: times.clock_label(c, -2), ["20260413233000"])
    assert shifted == ["21:30:00"]


def test_chart_label(spark):
    shown = values(spark, lambda c: times.chart_label(c.cast("date")), ["2026-04-30", "2026-05-01"])
    assert shown == ["30 Apr", "01 May"]


def test_percent_encoding_equals_the_standard_one(spark):
    inputs = ["a/b", "a b", "a*b", "a~b", "é/漢", "a+b%c", "".join(map(chr, range(32, 127))), ""]
    assert values(spark, text.percent_encoded, inputs) == [quote(v, safe="") for v in inputs]


def test_trimmed_repo_key_of_blank_is_empty(spark):
    assert values(spark, text.trimmed_repo_key, [" a/b ", "  ", None]) == ["a%2Fb", "", ""]


def test_padded_numbers_grow_beyond_their_width(spark):
    assert values(spark, text.padded, [7, 9999, 10000], "int") == ["0007", "9999", "10000"]


def test_key_parts(spark):
    inputs = ["2026-04-13#a/b#c", "plain", "x#"]
    assert values(spark, text.key_head, inputs) == ["2026-04-13", "plain", "x"]
    assert values(spark, text.key_tail, inputs) == ["a/b#c", None, ""]


def test_language_labels(spark):
    inputs = [" Go ", "", "   ", None, "Unknown"]
    assert values(spark, text.language_label, inputs) == ["Go"] + ["Unknown"] * 4
    assert values(spark, text.known_language, inputs) == ["Go", None, None, None, None]


def test_path_day_and_hour(spark):
    inputs = [
        "/a/2026-04-13.json.gz",
        "/a/2026-04-13-7.json.gz",
        "/2025-01-01/2026-04-13-23.json.gz",
        "/a/readme.json.gz",
        "2026-04-13.json.gz",
    ]
    day = "2026-04-13"
    assert values(spark, text.path_day, inputs) == [day, day, day, None, None]
    assert values(spark, text.path_hour, inputs) == [None, 7, 23, None, None]


def test_owner_and_name(spark):
    shown = values(spark, text.owner_and_name, ["a/b", "a/b/c", "plain", None])
    assert [tuple(v) if v else None for v in shown] == [("a", "b"), ("a", "b/c"), None, None]


def lenient(value):
    try:
        return int(float(value))
    except (ValueError, TypeError, OverflowError):
        return 0


def strict(value):
    try:
        return int(value)
    except (ValueError, TypeError):
        return 0


NUMBERS = [
    "12", "12.7", "-3.9", "1e3", " 7 ", "+5", ".5", "5.", "abc", "", "nan", "inf", None, "1_000",
    "12d", "1.0f", "0x10", "--1", "1e", "\t8\n", "-0", "1__0",
]


@pytest.mark.parametrize("ours, theirs", [(numbers.lenient_int, lenient), (numbers.strict_int, strict)])
def test_number_parsing_equals_python(spark, ours, theirs):
    assert values(spark, ours, NUMBERS) == [theirs(v) for v in NUMBERS]


def test_bar_width_has_a_floor(spark):
    data = spark.createDataFrame([(0, 200), (50, 200), (5, 0)], "v bigint, top bigint")
    shown = data.select(numbers.bar_width(F.col("v"), F.col("top"), 1.5).alias("w")).collect()
    assert [row.w for row in shown] == [1.5, 25.0, 500.0]


def test_whole_percent_truncates(spark):
    assert values(spark, numbers.whole_percent, [0.999, 0.0, 0.505], "double") == [99, 0, 50]
