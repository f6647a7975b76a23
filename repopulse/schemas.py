"""Fixed schemas of every input and table, as DDL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names and types of the exchanged records and tables.
RAW_EVENT = (
    "id string, type string, repo struct<name:string>, actor struct<login:string>, "
    "created_at string, "
    "payload struct<forkee:struct<fork:boolean,parent:struct<full_name:string>>>"
)
MESSAGE = (
    "event_id string, event_type string, repo_name string, actor string, language string, "
    "stars_count bigint, forks_count bigint, watchers_count bigint, created_at string"
)
ARCHIVE_EVENT = "type string, repo struct<name:string>, created_at string"
CORRUPT_COLUMN = "_corrupt_record"
METADATA = (
    "repo_name string, language string, stars_count bigint, forks_count bigint, "
    "watchers_count bigint"
)
REPOS = "repo_key string, full_name string, language string"
LIVE_EVENTS = "row_key string, repo string, type string, language string, repo_key string"
LIVE_METRICS = (
    "row_key string, name string, event_type string, language string, stars bigint, "
    "forks bigint, watchers bigint, repo_key string, week string, count bigint, window string"
)
WEEKLY_METRICS = (
    "row_key string, name string, language string, repo_key string, stars bigint, "
    "forks bigint, velocity bigint, fork_velocity bigint, repo_count bigint, "
    "api_stars bigint, api_forks bigint, day string"
)
LANGUAGE_DAYS = (
    "language string, stars bigint, repos bigint, repo_sketch binary, day string"
)
DAILY_COUNTS = (
    "repo_name string, star_count bigint, fork_count bigint, total_events bigint, "
    "day string, source string"
)
SNAPSHOT = (
    "name string, last_stars bigint, last_forks bigint, last_api_stars bigint, "
    "last_api_forks bigint, last_day string"
)
PROCESSED_DAYS = "day string"
PREDICTIONS = "name string, probability double, cluster string, predicted_growth double"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table of the given schema."""
    return spark.createDataFrame([], schema)


def column_names(schema: str) -> list[str]:
    """Top-level column names of one of the flat schemas above."""
    return [field.split()[0] for field in schema.split(", ")]
