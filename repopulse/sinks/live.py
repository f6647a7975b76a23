"""Sinks of the live streams.

Every micro-batch writes folders named after its query and batch id and
overwrites them, so a batch repeated after a failure leaves the same table, and a
stream begun anew with an empty checkpoint never touches what an earlier one
wrote. Live rows and events are partitioned by day first, so readers of the newest
ones skip the rest. Errors are not caught: the stream stops and resumes from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators.enrichment import attach_metadata
from repopulse.operators.metrics import latest_by_key
from repopulse.session import adaptive, claim_number, folder_names, remove_folder, staged
from repopulse.sinks.partitions import replace_partitions
from repopulse.sinks.rows import (
    live_event_rows,
    live_metrics_rows,
    message_values,
    repo_rows,
    with_live_keys,
)
from repopulse.sources.tables import Tables, read_days, read_table, recent_days

# Name under which Spark tells a micro-batch which query it belongs to.
QUERY_ID = "sql.streaming.queryId"
BATCHES_PER_START = 1_000_000_000
VERSION = "version"
LIVE_KEYS = ["window", "name", "event_type", "language"]
LIVE_VALUES = ["stars", "forks", "watchers", "count"]
LIVE_LOG = f"{schemas.LIVE_METRICS}, {VERSION} bigint, day string, query string, batch_id bigint"
LIVE_HISTORY = (
    "window string, name string, event_type string, language string, stars bigint, "
    f"forks bigint, watchers bigint, count bigint, {VERSION} bigint, day string"
)
REPOS_FOLDED = f"{schemas.REPOS}, {VERSION} bigint"
REPOS_LOG = f"{schemas.REPOS}, {VERSION} bigint, query string, batch_id bigint"
EVENTS_LOG = f"{schemas.LIVE_EVENTS}, day string, query string, batch_id bigint"


def query_of(session: SparkSession) -> str:
    """Id of the stream whose batch is being written; it lasts as long as its checkpoint."""
    return session.sparkContext.getLocalProperty(QUERY_ID) or "none"


def batch_path(table: str, query: str, batch_id: int) -> str:
    return f"{table}/query={query}/batch_id={batch_id}"


def next_start(spark: SparkSession, tables: Tables) -> int:
    """A number above that of every earlier start of a live stream, and stored as such.

    Starts are told apart by what is stored, not by a clock, as the next one may
    happen on another host; two that happen at once get different numbers.
    """
    return claim_number(spark, tables.live_starts, "start=")


def versions(tables: Tables) -> Callable[[SparkSession, int], Column]:
    """Version of a stream's batches: they grow with its start and then with the batch."""
    start: list[int] = []

    def of(session: SparkSession, batch_id: int) -> Column:
        if not start:
            start.append(next_start(session, tables))
        return F.lit(start[0] * BATCHES_PER_START + batch_id).cast("bigint").alias(VERSION)

    return of


def write_batch(rows: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Rows below `day=/query=/batch_id=`, replacing what the same batch wrote before."""
    named = rows.withColumns({"query": F.lit(query), "batch_id": F.lit(batch_id).cast("bigint")})
    (
        named.hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "query", "batch_id")
        .parquet(path)
    )


def upsert_live_batch(tables: Tables) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that logs changed windows.

    Versions grow with the start of the stream and then with its batches, so the
    last write of a row wins even across checkpoints. Nothing stored is listed or
    read, so the work of a batch does not grow with what is stored.
    """
    version_of = versions(tables)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with adaptive(session):
            version = version_of(session, batch_id)
            rows = live_metrics_rows(batch).select("*", version, _day().alias("day"))
            write_batch(rows, tables.live_metrics, query_of(session), batch_id)

    return write


def append_events(tables: Tables) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that writes every valid event to the feed table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with adaptive(session):
            compact_day = F.to_date(F.substring("row_key", 1, 8), "yyyyMMdd").cast("string")
            rows = live_event_rows(batch).withColumn("day", compact_day)
            write_batch(rows, tables.live_events, query_of(session), batch_id)

    return write


def append_unreadable(tables: Tables) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that keeps events whose time cannot be read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        path = batch_path(tables.unreadable, query_of(batch.sparkSession), batch_id)
        batch.drop("event_timestamp").write.mode("overwrite").parquet(path)

    return write


def publish_batch(
    tables: Tables, metadata: DataFrame, topic: dict[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback that enriches events and publishes them as messages."""

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with adaptive(session):
            values = message_values(attach_metadata(batch, metadata))
            if topic is not None:
                values.write.format("kafka").options(**topic).save()
            else:
                path = batch_path(tables.messages, query_of(session), batch_id)
                values.hint("rebalance").write.mode("overwrite").text(path)

    return write


def log_repos(tables: Tables) -> Callable[[DataFrame, int], None]:
    """K2: micro-batch callback that logs the repositories the stream has not met before.

    Which of them are new is known to the state of the stream, so nothing stored is
    read, and a repository is logged once however long the stream runs.
    """
    version_of = versions(tables)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with adaptive(session):
            rows = repo_rows(batch).select("*", version_of(session, batch_id))
            path = batch_path(tables.repos, query_of(session), batch_id)
            rows.hint("rebalance").write.mode("overwrite").parquet(path)

    return write


def _first_repos(log: DataFrame) -> DataFrame:
    order = F.struct(VERSION, "full_name", "language")
    first = log.groupBy("repo_key").agg(F.min(order).alias("first"))
    return first.select("repo_key", "first.full_name", "first.language", f"first.{VERSION}")


def _stored_repos(spark: SparkSession, tables: Tables) -> DataFrame:
    """The log and the newest folded run; older runs say nothing more."""
    log = read_table(spark, tables.repos, REPOS_LOG, first=True).drop("query", "batch_id")
    run = folder_names(spark, tables.repos_folded, "run=")[-1:]
    folded = [read_table(spark, f"{tables.repos_folded}/run={r}", REPOS_FOLDED) for r in run]
    for rows in folded:
        log = log.unionByName(rows)
    return log


def compact_repos(spark: SparkSession, tables: Tables, run: str) -> list[str]:
    """K2: fold the log of repositories into one row each, below a folder named `run`.

    Names of runs must ascend, as times or numbers of one width do. The folded rows
    keep their version, so reading them beside the log is right whether or not the
    folded batches have been removed. Returned are those batches' folders, for
    `remove_folded`.
    """
    batches = batch_folders(spark, tables.repos, ["query=", "batch_id="])
    first = _first_repos(_stored_repos(spark, tables))
    first.hint("rebalance").write.mode("overwrite").parquet(f"{tables.repos_folded}/run={run}")
    return batches


def batch_folders(spark: SparkSession, path: str, levels: list[str]) -> list[str]:
    """Folders below `path`, one level per prefix."""
    found = [path]
    for prefix in levels:
        found = [f"{p}/{prefix}{name}" for p in found for name in folder_names(spark, p, prefix)]
    return found


def remove_folded(spark: SparkSession, tables: Tables, folders: Iterable[str]) -> None:
    """Remove batches and older runs that a newer run holds.

    Readers that were planned before may still need them, so some time should pass
    between folding and this. A batch that the stream repeats is written again.
    """
    for folder in folders:
        remove_folder(spark, folder)
    for run in folder_names(spark, tables.repos_folded, "run=")[:-1]:
        remove_folder(spark, f"{tables.repos_folded}/run={run}")


def _newest_versions(versions: DataFrame) -> DataFrame:
    columns = [*LIVE_KEYS, *LIVE_VALUES, VERSION]
    return latest_by_key(versions.select(*columns), LIVE_KEYS, VERSION)


def _day() -> Column:
    return F.substring("window", 1, 10)


def _log_values(log: DataFrame) -> DataFrame:
    return log.select(*LIVE_KEYS, *LIVE_VALUES, VERSION, "day")


def live_days(spark: SparkSession, tables: Tables) -> list[str]:
    """Days that have live rows, from folder names."""
    paths = (tables.live_metrics, tables.live_history)
    return sorted({day for path in paths for day in folder_names(spark, path, "day=")})


def _stored_versions(spark: SparkSession, tables: Tables, days: list[str]) -> DataFrame:
    history = read_days(spark, tables.live_history, LIVE_HISTORY, days)
    log = read_days(spark, tables.live_metrics, LIVE_LOG, days)
    return history.unionByName(_log_values(log))


def read_live_metrics(spark: SparkSession, tables: Tables) -> DataFrame:
    """K1: the newest version of every live row, from compacted days and the log."""
    days = live_days(spark, tables)
    return with_live_keys(_newest_versions(_stored_versions(spark, tables, days)))


def recent_live_metrics(spark: SparkSession, tables: Tables, days: int = 2) -> DataFrame:
    """K1 restricted to the newest days, which hold the newest windows.

    Days come from folder names, and nothing older is listed or opened.
    """
    recent = live_days(spark, tables)[-days:]
    return with_live_keys(_newest_versions(_stored_versions(spark, tables, recent)))


def compact_live_metrics(
    spark: SparkSession, tables: Tables, days: Iterable[str] | None = None
) -> list[str]:
    """K1: fold the log of the given days, by default all, into partitions of newest versions.

    The folders to fold are listed first and only they are read, so batches that
    arrive meanwhile wait for the next time. Rows keep their version, so reading
    history and log together is right whether or not the folded batches have been
    removed. Returned are their folders, for `remove_folded`.
    """
    logged = folder_names(spark, tables.live_metrics, "day=")
    wanted = logged if days is None else sorted(set(days) & set(logged))
    batches = [
        folder
        for day in wanted
        for folder in batch_folders(
            spark, f"{tables.live_metrics}/day={day}", ["query=", "batch_id="]
        )
    ]
    if not batches:
        return []
    reader = spark.read.schema(LIVE_LOG).option("basePath", tables.live_metrics)
    log = _log_values(reader.parquet(*batches))
    history = read_days(spark, tables.live_history, LIVE_HISTORY, wanted)
    newest = staged(spark, _newest_versions(history.unionByName(log)), "live-history")
    replace_partitions(newest.withColumn("day", _day()), tables.live_history, "day")
    return batches


def expire_live_days(
    spark: SparkSession, tables: Tables, today: str, keep_live: int = 7, keep_events: int = 7
) -> None:
    """K1, K3: remove live rows and feed events of days before the ones to keep."""
    for path, days in (
        (tables.live_metrics, keep_live),
        (tables.live_history, keep_live),
        (tables.live_events, keep_events),
    ):
        oldest = (date.fromisoformat(today) - timedelta(days=days)).isoformat()
        for day in folder_names(spark, path, "day="):
            if day <= oldest:
                remove_folder(spark, f"{path}/day={day}")


def read_repos(spark: SparkSession, tables: Tables) -> DataFrame:
    """K2: the repository dimension, one row per key with the language first seen."""
    return _first_repos(_stored_repos(spark, tables)).drop(VERSION)


def read_live_events(spark: SparkSession, tables: Tables) -> DataFrame:
    """K3: the event feed, with the `day` it is partitioned by."""
    return read_table(spark, tables.live_events, EVENTS_LOG, first=True).drop("query", "batch_id")


def recent_live_events(spark: SparkSession, tables: Tables, rows: int) -> DataFrame:
    """K3 restricted to as many of the newest days as hold that many events."""
    found = recent_days(spark, tables.live_events, EVENTS_LOG, rows)
    return found.drop("query", "batch_id")
