"""Top-k with ranks and bar widths for the panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions.numbers import bar_width


def top_ranked(rows: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first `limit` rows by `order`, numbered from 1.

    The limit comes first and plans as a top-k, so the unpartitioned window
    numbers no more than `limit` rows.
    """
    numbering = Window.orderBy(*order)
    return rows.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(numbering))


def with_bars(top: DataFrame, values: dict[str, str], floor: float) -> DataFrame:
    """Widths relative to the largest of the named columns in a top-k table.

    `values` maps each new width column to the value it shows. Use it on limited
    tables only, as the largest value comes from a window over all rows.
    """
    whole = Window.partitionBy()
    shown = {name: F.greatest(F.col(source), F.lit(0)) for name, source in values.items()}
    per_row = F.greatest(*shown.values()) if len(shown) > 1 else next(iter(shown.values()))
    largest = F.max(per_row).over(whole)
    return top.withColumns(
        {name: bar_width(value, largest, floor) for name, value in shown.items()}
    )
