"""Timestamps, days and the text labels made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only shape of `created_at` the live stream accepts.
STREAM_TIME = "yyyy-MM-dd'T'HH:mm:ssX"


def stream_time(text: Column) -> Column:
    """Whole-second ISO time ending in Z; anything else is null."""
    return F.try_to_timestamp(text, F.lit(STREAM_TIME))


def archive_time(text: Column) -> Column:
    """Any ISO time, with fractions and offsets; null if unreadable."""
    return F.try_to_timestamp(text)


def day_text(moment: Column) -> Column:
    """The UTC day as yyyy-MM-dd."""
    return moment.cast("date").cast("string")


def parsed_day(day: Column, week: Column | None = None) -> Column:
    """day column as a date, older tables' week column as the fallback."""
    text = day if week is None else F.coalesce(day, week)
    return text.try_cast("date")


def week_key(window_start: Column) -> Column:
    """Monday midnight of the window's week, `unknown` if unreadable."""
    monday = F.date_trunc("week", window_start.cast("string").try_cast("timestamp"))
    return F.coalesce(F.date_format(monday, "yyyy-MM-dd HH:mm:ss"), F.lit("unknown"))


def compact_key(moment: Column) -> Column:
    """Sortable digits of a moment, `none` for null."""
    return F.coalesce(F.date_format(moment, "yyyyMMddHHmmss"), F.lit("none"))


def clock_label(compact: Column, offset_hours: int = 1) -> Column:
    """Compact key as HH:mm:ss at a fixed offset from UTC.

    Digits that are no real moment are sliced as they are; text too short for
    that is shown unchanged.
    """
    moment = F.try_to_timestamp(compact, F.lit("yyyyMMddHHmmss"))
    shifted = moment + F.make_dt_interval(hours=F.lit(offset_hours))
    sliced = F.concat_ws(
        ":", F.substring(compact, 9, 2), F.substring(compact, 11, 2), F.substring(compact, 13, 2)
    )
    return (
        F.when(moment.isNotNull(), F.date_format(shifted, "HH:mm:ss"))
        .when(F.length(compact) >= 14, sliced)
        .otherwise(compact)
    )


def chart_label(day: Column) -> Column:
    """Day as `dd Mon`; sort by the day itself, not by this text."""
    return F.date_format(day, "dd MMM")


def bound_text(moment: Column) -> Column:
    """Window bound as text."""
    return moment.cast("string")
