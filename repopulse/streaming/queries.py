"""The streams: publish clean messages, live windows, repositories, live feed (Q1-Q3, K2).

Each returns a started query. Every query has a checkpoint folder of its own
beside, not inside, the others'.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repopulse.functions.text import UNKNOWN_LANGUAGE, UNKNOWN_NAME, or_default
from repopulse.operators.cleaning import (
    DUPLICATE_MEMORY,
    LATENESS,
    distinct_event_stream,
    resolve_raw_events,
    valid_messages,
    with_lateness,
)
from repopulse.operators.metrics import WINDOW_WIDTH, windowed_activity
from repopulse.sinks.live import (
    append_events,
    append_unreadable,
    log_repos,
    publish_batch,
    upsert_live_batch,
)
from repopulse.sources.feed import parse_messages
from repopulse.sources.tables import Tables

# How often each stream looks for new input.
METRICS_TRIGGER = "30 seconds"
FEED_TRIGGER = "10 seconds"
PUBLISH_TRIGGER = "5 seconds"


def _trigger(every: str | None) -> dict:
    """Regular trigger, or with None one pass over what is there."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def start(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None,
    mode: str = "append",
) -> StreamingQuery:
    """A started query whose micro-batches go to `write`.

    `write` must leave the same result when a batch is repeated: a batch that fails,
    even after its rows are stored, is run again from the checkpoint.
    """
    stream = rows.writeStream.outputMode(mode).foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def clean_events(
    raw: DataFrame, delay: str = DUPLICATE_MEMORY, spread_copies: bool = True
) -> DataFrame:
    """Q1 up to the metadata: F1, F5, R7.

    Events without a readable time are left out, as they cannot expire from the
    duplicate memory; `keep_unreadable` stores them.
    """
    events = resolve_raw_events(raw).where(F.col("event_timestamp").isNotNull())
    return distinct_event_stream(with_lateness(events, delay), spread_copies)


def keep_unreadable(
    raw: DataFrame, tables: Tables, checkpoint: str, every: str | None = PUBLISH_TRIGGER
) -> StreamingQuery:
    """The events that Q1 leaves out for their time, to a table of their own."""
    unreadable = resolve_raw_events(raw).where(F.col("event_timestamp").isNull())
    return start(unreadable, append_unreadable(tables), checkpoint, every)


def publish_messages(
    raw: DataFrame,
    metadata: DataFrame,
    tables: Tables,
    checkpoint: str,
    every: str | None = PUBLISH_TRIGGER,
    topic: dict[str, str] | None = None,
    **cleaning,
) -> StreamingQuery:
    """Q1, K7: clean messages to the topic given by its sink options, else to text files."""
    write = publish_batch(tables, metadata, topic)
    return start(clean_events(raw, **cleaning), write, checkpoint, every)


def live_windows(
    feed: DataFrame,
    width: str = WINDOW_WIDTH,
    delay: str = LATENESS,
    drop_duplicates: bool = False,
    spread_copies: bool = True,
) -> DataFrame:
    """Q2 up to the write: S2, X1, F2, R1, A1, optionally with R7.

    Published messages are distinct already. For a topic whose messages are
    not, R7 shares the windows' watermark, so it also drops events later than
    `delay` whose window is still open; give a longer delay if that matters.
    """
    messages = with_lateness(valid_messages(parse_messages(feed)), delay)
    if drop_duplicates:
        messages = distinct_event_stream(messages, spread_copies)
    return windowed_activity(messages, width)


def stream_live_metrics(
    feed: DataFrame,
    tables: Tables,
    checkpoint: str,
    every: str | None = METRICS_TRIGGER,
    **windows,
) -> StreamingQuery:
    """Changed windows of every micro-batch to the live tables."""
    rows = live_windows(feed, **windows)
    return start(rows, upsert_live_batch(tables), checkpoint, every, mode="update")


def seen_repos(feed: DataFrame, spread_copies: bool = False) -> DataFrame:
    """K2: each repository with a language, once, for as long as the stream's checkpoint lasts.

    Names and languages that were met are the stream's state, which grows like the
    dimension. A hot repository's events meet in one task, though only as two short
    texts; `spread_copies` lets each input partition drop its own first, for a
    state of up to one entry per partition.
    """
    named = valid_messages(parse_messages(feed)).select(
        or_default(F.col("repo_name"), UNKNOWN_NAME).alias("full_name"),
        or_default(F.col("language"), UNKNOWN_LANGUAGE).alias("language"),
    )
    keys = ["full_name", "language"]
    if spread_copies:
        named = (
            named.withColumn("source_partition", F.spark_partition_id())
            .dropDuplicates([*keys, "source_partition"])
            .select(*keys)
        )
    return named.dropDuplicates(keys)


def stream_repos(
    feed: DataFrame,
    tables: Tables,
    checkpoint: str,
    every: str | None = METRICS_TRIGGER,
    spread_copies: bool = False,
) -> StreamingQuery:
    """K2: repositories not met before to the log of the dimension.

    Of several languages that of the earliest batch sticks, then the first by text.
    """
    return start(seen_repos(feed, spread_copies), log_repos(tables), checkpoint, every)


def stream_live_events(
    feed: DataFrame, tables: Tables, checkpoint: str, every: str | None = FEED_TRIGGER
) -> StreamingQuery:
    """Every valid event to the feed table, each batch in folders of its own.

    So a batch that is repeated replaces itself, and a stream begun anew with
    another checkpoint adds to the table.
    """
    events = valid_messages(parse_messages(feed))
    return start(events, append_events(tables), checkpoint, every)


def lateness_report(query: StreamingQuery) -> list[dict]:
    """Per micro-batch of a query its watermark, its rows, and the rows dropped as too late.

    Rows that one input partition would have added to one window and group count once.
    """
    return [
        {
            "batch_id": progress.batchId,
            "watermark": progress.eventTime.get("watermark"),
            "rows": progress.numInputRows,
            "dropped": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        }
        for progress in query.recentProgress
    ]


def run_live(
    spark: SparkSession,
    feed: DataFrame,
    tables: Tables,
    checkpoints: str,
    raw: DataFrame | None = None,
    metadata: DataFrame | None = None,
    topic: dict[str, str] | None = None,
    **windows,
) -> None:
    """Run metrics, repositories and feed until one of them stops, then stop all.

    With `raw` events and their `metadata`, the publishing stream and the one that
    keeps unreadable events run beside them. The failure of any surfaces here.
    """
    started: list[StreamingQuery] = []
    try:
        started.append(stream_live_metrics(feed, tables, f"{checkpoints}/live-metrics", **windows))
        started.append(stream_repos(feed, tables, f"{checkpoints}/live-repos"))
        started.append(stream_live_events(feed, tables, f"{checkpoints}/live-events"))
        if raw is not None:
            started.append(
                publish_messages(raw, metadata, tables, f"{checkpoints}/publish", topic=topic)
            )
            started.append(keep_unreadable(raw, tables, f"{checkpoints}/unreadable"))
        spark.streams.awaitAnyTermination()
    finally:
        for query in started:
            query.stop()
