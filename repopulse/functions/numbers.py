"""Lenient number parsing and panel arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"\d+(?:_\d+)*"
WHOLE = rf"^\s*[+-]?{DIGITS}\s*$"
DECIMAL = rf"^\s*[+-]?(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?\s*$"


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, r"[\s_]", "")


def lenient_int(text: Column) -> Column:
    """Number text truncated to a whole number; 0 if it is none."""
    value = F.when(text.rlike(DECIMAL), _plain(text)).try_cast("double").try_cast("bigint")
    return F.coalesce(value, F.lit(0).cast("bigint"))


def strict_int(text: Column) -> Column:
    """Whole-number text only; 0 otherwise, so 12.7 gives 0."""
    value = F.when(text.rlike(WHOLE), _plain(text)).try_cast("bigint")
    return F.coalesce(value, F.lit(0).cast("bigint"))


def score(velocity: Column, fork_velocity: Column) -> Column:
    """Daily trending score."""
    return F.coalesce(velocity, F.lit(0)) + F.coalesce(fork_velocity, F.lit(0))


def bar_width(value: Column, largest: Column, floor: float) -> Column:
    """Percent of the largest value, never below the floor."""
    return F.greatest(value / F.greatest(largest, F.lit(1)) * 100, F.lit(floor))


def whole_percent(probability: Column) -> Column:
    """Probability as a truncated percentage."""
    return (probability * 100).cast("int")
