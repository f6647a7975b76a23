"""Serving tables: where they live and how they are read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.session import folder_names


@dataclass(frozen=True)
class Tables:
    """Paths of the serving tables below one root folder.

    The snapshot's number of buckets is fixed for the life of the tables.
    """

    root: str
    snapshot_buckets: int = 16

    @property
    def weekly_metrics(self) -> str:
        return f"{self.root}/weekly_metrics"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/last_day_snapshots"

    @property
    def snapshot_folds(self) -> str:
        return f"{self.root}/snapshot_folds"

    @property
    def daily_counts(self) -> str:
        return f"{self.root}/daily_counts"

    @property
    def processed_days(self) -> str:
        return f"{self.root}/processed_days"

    @property
    def repos(self) -> str:
        return f"{self.root}/repos"

    @property
    def live_metrics(self) -> str:
        return f"{self.root}/live_metrics"

    @property
    def live_history(self) -> str:
        return f"{self.root}/live_history"

    @property
    def live_starts(self) -> str:
        return f"{self.root}/live_starts"

    @property
    def repos_folded(self) -> str:
        return f"{self.root}/repos_folded"

    @property
    def language_days(self) -> str:
        return f"{self.root}/language_days"

    @property
    def unreadable(self) -> str:
        return f"{self.root}/unreadable_events"

    @property
    def live_events(self) -> str:
        return f"{self.root}/live_events"

    @property
    def messages(self) -> str:
        return f"{self.root}/messages"

    @property
    def damaged_files(self) -> str:
        return f"{self.root}/damaged_files"

    @property
    def models(self) -> str:
        return f"{self.root}/breakout_models"

    @property
    def predictions(self) -> str:
        return f"{self.root}/ml_predictions"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


def read_table(
    spark: SparkSession, path: str, schema: str, first: bool = False, below: str = ""
) -> DataFrame:
    """A table with its fixed schema, or the folders of it that the pattern `below` names.

    With `first`, a table that no run has written yet reads as empty; without, a
    path that does not exist is an error.
    """
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(f"{path}/{below}" if below else path)
    except AnalysisException as error:
        if not first or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return schemas.empty(spark, schema)


def read_days(
    spark: SparkSession, path: str, schema: str, days: Iterable[str], day: str = "day"
) -> DataFrame:
    """Rows of the named days of a day-partitioned table; no other day's folder is listed.

    Days that are not stored have no rows.
    """
    stored = set(folder_names(spark, path, f"{day}="))
    folders = [f"{path}/{day}={name}" for name in sorted(set(days)) if name in stored]
    if not folders:
        return schemas.empty(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def scan(
    table: DataFrame,
    limit: int = 0,
    prefix: str = "",
    latest_first: bool = False,
    key: str = "row_key",
) -> DataFrame:
    """Rows in key order, optionally by key prefix, newest first and limited.

    A limit plans as a top-k over all partitions; `0` returns every row.
    """
    rows = table.where(F.col(key).startswith(prefix)) if prefix else table
    ordered = rows.orderBy(F.col(key).desc() if latest_first else F.col(key).asc())
    return ordered.limit(limit) if limit > 0 else ordered


def newest_days(spark: SparkSession, path: str, count: int, day: str = "day") -> list[str]:
    """The newest days of a day-partitioned table, from the names of its folders."""
    return folder_names(spark, path, f"{day}=")[-count:]


def recent_days(
    spark: SparkSession, path: str, schema: str, rows: int, day: str = "day"
) -> DataFrame:
    """As many of the newest days of the table stored at `path` as hold `rows` rows.

    Days come from folder names, and the rows of each are counted up to `rows`
    only, so a newest-first scan lists and reads one day as a rule and never more
    days than it needs.
    """
    taken, found = [], 0
    for name in reversed(folder_names(spark, path, f"{day}=")):
        taken.append(name)
        found += read_days(spark, path, schema, [name], day).limit(rows).count()
        if found >= rows:
            break
    return read_days(spark, path, schema, taken, day)


def newest_live_metrics(live_metrics: DataFrame, limit: int = 20) -> DataFrame:
    """S9."""
    return scan(live_metrics, limit, latest_first=True)


def newest_live_events(live_events: DataFrame, limit: int = 30) -> DataFrame:
    """S9."""
    return scan(live_events, limit, latest_first=True)


def newest_weekly_metrics(weekly: DataFrame, limit: int = 200) -> DataFrame:
    """Newest daily rows."""
    return scan(weekly.where(F.contains("row_key", F.lit("#"))), limit, latest_first=True)


def first_predictions(predictions: DataFrame, limit: int = 20) -> DataFrame:
    """Predictions in key order."""
    return scan(predictions, limit, key="name")


def processed_days(spark: SparkSession, tables: Tables) -> DataFrame:
    """Days the batch has finished."""
    return read_table(spark, tables.processed_days, schemas.PROCESSED_DAYS, first=True).distinct()
