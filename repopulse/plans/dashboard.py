"""All panels over the stored tables, as one refresh reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repopulse import schemas
from repopulse.plans import panels
from repopulse.sinks.daily import read_language_days
from repopulse.sinks.live import recent_live_events, recent_live_metrics
from repopulse.sources.tables import Tables, newest_days, read_days, read_table

# Rows each panel shows.
TRENDING_ROWS = 8
FEED_ROWS = 20
DAILY_ROWS = 10
INSIGHT_ROWS = 5


def dashboard(spark: SparkSession, tables: Tables) -> dict[str, DataFrame]:
    """Q6-Q11: one table per panel. Tables not written yet give empty panels.

    The newest days are found from folder names, so the live and daily panels list and
    open no older files, and the language panels read a few hundred rows a day.
    """
    live = recent_live_metrics(spark, tables)
    events = recent_live_events(spark, tables, FEED_ROWS)
    languages = read_language_days(spark, tables)
    day = newest_days(spark, tables.weekly_metrics, 1)
    newest = read_days(spark, tables.weekly_metrics, schemas.WEEKLY_METRICS, day)
    predictions = read_table(spark, tables.predictions, schemas.PREDICTIONS, first=True)
    now = panels.trending_now(live, TRENDING_ROWS)
    before = panels.trending_window(live, TRENDING_ROWS, nth=2)
    return {
        "trending_now": panels.with_new_flag(now, before),
        "rising_languages": panels.rising_languages(languages),
        "activity_feed": panels.activity_feed(events, FEED_ROWS),
        "historical_trends": panels.historical_slots(languages),
        "trending_daily": panels.trending_daily(newest, DAILY_ROWS),
        "ai_insights": panels.ai_insights(predictions, INSIGHT_ROWS),
    }
