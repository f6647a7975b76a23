"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words, as a pattern; the letters that are lower-cased.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of other characters than white space, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def count_of(text: Column, others: str) -> Column:
    """Characters that stay once those matching the pattern `others` are removed."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")
