"""The six panel queries (Q6-Q11) and the new-entrant flag.

Each takes a serving table and stays distributed until its last few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.numbers import score, whole_percent
from repopulse.functions.text import UNKNOWN_LANGUAGE, key_head, language_label, or_default
from repopulse.functions.times import chart_label, clock_label, parsed_day
from repopulse.operators.ranking import top_ranked, with_bars
from repopulse.sources.tables import newest_live_events

# ---- live panels ---------------------------------------------------------------------------


def _rank_repos(live_rows: DataFrame, limit: int) -> DataFrame:
    """Repositories by their highest star count, ties to the newest row."""
    per_repo = (
        live_rows.where(or_default(F.col("name"), "") != "")
        .groupBy(F.col("name").alias("repo"))
        .agg(
            F.max_by("language", "row_key").alias("language"),
            F.greatest(F.max("stars"), F.lit(0)).alias("stars"),
            F.max("row_key").alias("newest_key"),
        )
    )
    top = top_ranked(per_repo, limit, F.col("stars").desc(), F.col("newest_key").desc())
    return top.select("rank", "repo", "language", "stars")


def nth_newest_window(live_metrics: DataFrame, nth: int = 1) -> Column:
    """Start of the newest window, or of the nth newest, as a scalar; null if there are fewer."""
    starts = live_metrics.select("window").distinct().orderBy(F.col("window").desc()).limit(nth)
    return starts.agg(F.when(F.count("*") == nth, F.min("window"))).scalar()


def trending_window(live_metrics: DataFrame, limit: int = 8, nth: int = 1) -> DataFrame:
    """Repositories of the newest window, or of the nth newest, by stars."""
    window = nth_newest_window(live_metrics, nth)
    return _rank_repos(live_metrics.where(F.col("window") == window), limit)


def trending_now(live_metrics: DataFrame, limit: int = 8) -> DataFrame:
    """Repositories with the most stars among all rows of the newest window."""
    return trending_window(live_metrics, limit)


def new_entrants(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Ranked repositories that the previous ranking did not have."""
    return current.join(previous.select("repo"), "repo", "left_anti")


def with_new_flag(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Every ranked repository, and whether the previous ranking did not have it."""
    known = previous.select("repo", F.lit(False).alias("is_new"))
    return current.join(known, "repo", "left").select(
        *current.columns, F.coalesce("is_new", F.lit(True)).alias("is_new")
    )


def activity_feed(live_events: DataFrame, limit: int = 20, offset_hours: int = 1) -> DataFrame:
    """Newest events with a clock time."""
    return newest_live_events(live_events, limit).select(
        "row_key",
        clock_label(key_head(F.col("row_key")), offset_hours).alias("timestamp"),
        F.coalesce("type", F.lit("Event")).alias("type"),
        F.coalesce("repo", F.lit("")).alias("repo"),
    )


# ---- language panels -----------------------------------------------------------------------


def _labelled(weekly: DataFrame) -> DataFrame:
    """Readable days and languages, and whether the language is known."""
    rows = weekly.select(
        parsed_day(F.col("day")).alias("day"),
        language_label(F.col("language")).alias("language"),
        F.coalesce("stars", F.lit(0)).alias("stars"),
    ).where(F.col("day").isNotNull())
    return rows.withColumn("known", F.col("language") != UNKNOWN_LANGUAGE)


# F9 drops `Unknown` only if the table has any other language. Both cases read
# `known = highest known of the table`, so each panel below fetches that flag
# along with whatever else it needs to know in one scalar subquery.


def language_days(weekly: DataFrame) -> DataFrame:
    """Stars per day and language."""
    rows = _labelled(weekly)
    any_known = rows.agg(F.max("known")).scalar()
    return (
        rows.where(F.col("known") == any_known)
        .groupBy("day", "language")
        .agg(F.sum("stars").alias("stars"))
    )


def _newest_two_days(rows: DataFrame) -> Column:
    """Newest and earlier (known, day) of the rows that count, as a scalar."""
    moment = F.struct("known", "day")
    newest_first = rows.select(moment.alias("at")).distinct().orderBy(F.col("at").desc()).limit(2)
    both = F.struct(F.max("at").alias("newest"), F.min("at").alias("earlier"))
    return newest_first.agg(both).scalar()


def rising_languages(weekly: DataFrame, limit: int = 10) -> DataFrame:
    """Stars per language on the newest day beside the day before it.

    Both days come out of one aggregate. Languages seen only on the earlier day
    are left out; an absent earlier day counts as zero.
    """
    rows = _labelled(weekly)
    days = _newest_two_days(rows)
    newest, earlier = days["newest"], days["earlier"]
    on_newest = F.col("day") == newest["day"]
    on_earlier = (F.col("day") == earlier["day"]) & (earlier["day"] < newest["day"])
    stars = F.col("stars")
    compared = (
        rows.where((F.col("known") == newest["known"]) & (on_newest | on_earlier))
        .groupBy("language")
        .agg(
            F.sum(F.when(on_newest, stars).otherwise(0)).alias("this_week"),
            F.sum(F.when(on_newest, 0).otherwise(stars)).alias("last_week"),
            F.max(on_newest).alias("is_current"),
        )
        .where("is_current")
        .drop("is_current")
    )
    top = top_ranked(compared, limit, F.col("this_week").desc(), F.col("language"))
    return with_bars(top, {"this_pct": "this_week", "last_pct": "last_week"}, floor=1.5)


def _top_languages(rows: DataFrame, limit: int) -> DataFrame:
    """Known languages by stars, or `Unknown` alone if there are none."""
    totals = rows.groupBy("language", "known").agg(F.sum("stars").alias("stars"))
    top = top_ranked(totals, limit, F.col("known").desc(), F.col("stars").desc(), F.col("language"))
    return top.where(F.col("known") | (F.col("rank") == 1))


def language_totals(weekly: DataFrame, limit: int = 5) -> DataFrame:
    """Languages with the most stars over all days."""
    return _top_languages(_labelled(weekly), limit).drop("known")


def historical_slots(weekly: DataFrame, limit: int = 5) -> DataFrame:
    """Q9, A10: one row per day with the stars of each top language, by rank.

    The labels arrive as one scalar struct, so days without any top language
    still get their row of zeros.
    """
    rows = _labelled(weekly)
    slots = range(1, limit + 1)
    named = [
        F.max(F.when(F.col("rank") == i, F.col("language"))).alias(f"lang_{i}") for i in slots
    ]
    top = _top_languages(rows, limit)
    labels = top.agg(F.struct(F.max("known").alias("any_known"), *named)).scalar()
    sums = [
        F.sum(F.when(F.col("language") == labels[f"lang_{i}"], F.col("stars")).otherwise(0)).alias(
            f"stars_{i}"
        )
        for i in slots
    ]
    return (
        rows.where(F.col("known") == labels["any_known"])
        .groupBy("day")
        .agg(*sums)
        .select(
            F.col("day").cast("string").alias("day"),
            chart_label(F.col("day")).alias("label"),
            *[labels[f"lang_{i}"].alias(f"lang_{i}") for i in slots],
            *[f"stars_{i}" for i in slots],
        )
    )


def historical_long(weekly: DataFrame, limit: int = 5) -> DataFrame:
    """Q9 as one row per day and top language."""
    slots = historical_slots(weekly, limit)
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("rank"),
                F.col(f"lang_{i}").alias("language"),
                F.col(f"stars_{i}").alias("stars"),
            )
            for i in range(1, limit + 1)
        ]
    )
    return (
        slots.select("day", "label", F.inline(entries))
        .where(F.col("language").isNotNull())
    )


def historical_wide(weekly: DataFrame, limit: int = 5) -> DataFrame:
    """Q9 with a column per top language; fetches at most `limit` labels to name them."""
    labels = [row.language for row in language_totals(weekly, limit).orderBy("rank").collect()]
    if not labels:
        return language_days(weekly).select(F.col("day").cast("string").alias("day")).distinct()
    per_day = language_days(weekly).groupBy("day").pivot("language", labels).agg(F.sum("stars"))
    return per_day.na.fill(0, labels).withColumn("day", F.col("day").cast("string"))


# ---- daily and prediction panels -----------------------------------------------------------


def trending_daily(weekly: DataFrame, limit: int = 10) -> DataFrame:
    """Q10, T4: highest scores among all rows of the newest day."""
    newest = weekly.agg(F.max("day")).scalar()
    scored = weekly.where(F.col("day") == newest).select(
        "row_key",
        F.coalesce("name", "row_key").alias("repo"),
        F.coalesce("language", F.lit(UNKNOWN_LANGUAGE)).alias("language"),
        score(F.col("velocity"), F.col("fork_velocity")).alias("score"),
        F.coalesce("stars", F.lit(0)).alias("stars"),
        F.coalesce("forks", F.lit(0)).alias("forks"),
    )
    top = top_ranked(scored, limit, F.col("score").desc(), F.col("row_key").desc())
    return with_bars(top, {"score_pct": "score"}, floor=2.0).drop("row_key")


def ai_insights(
    predictions: DataFrame, limit: int = 5, order_by: str = "probability"
) -> DataFrame:
    """The highest predictions by `order_by`, ties by name."""
    first = predictions.orderBy(F.col(order_by).desc(), "name").limit(limit)
    probability = F.coalesce("probability", F.lit(0.0))
    return first.select(
        F.col("name").alias("repo"),
        probability.alias("probability"),
        whole_percent(probability).alias("probability_pct"),
        F.coalesce("cluster", F.lit(UNKNOWN_LANGUAGE)).alias("cluster"),
        F.coalesce("predicted_growth", F.lit(0.0)).cast("bigint").alias("predicted_stars"),
    )
