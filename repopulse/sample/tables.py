"""The supplied tables seen as activity events and project metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.functions.text import UNKNOWN_LANGUAGE, percent_encoded
from repopulse.functions.times import stream_time
from repopulse.operators.cleaning import relevant

# Which kind of activity each kind of table event stands for.
KINDS = {
    "click": "WatchEvent",
    "signup": "ForkEvent",
    "view": "PushEvent",
    "purchase": "PullRequestEvent",
    "error": "IssuesEvent",
}
UNLABELLED_TYPE = "STANDARD"


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events table; the braces make the stream accept a file as well as a folder."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    if stream:
        return spark.readStream.schema(table.schema).parquet(f"{sf_dir}/events.{{parquet}}")
    return table


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


def repo_of(number: Column) -> Column:
    """Repository name standing for a user or part number."""
    owner = F.concat(F.lit("org"), (number % 10).cast("string"))
    return F.concat(owner, F.lit("/repo"), number.cast("string"))


def _kind() -> Column:
    """Nested conditions rather than a lookup: Spark turns a filter on them into a pushed one."""
    kind = F.lit(None).cast("string")
    for name, activity in reversed(KINDS.items()):
        kind = F.when(F.col("event_type") == name, activity).otherwise(kind)
    return kind


def _created_at() -> Column:
    return F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def raw_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """API events; a fork whose `k` is below 20 names one of five parents."""
    has_parent = (F.col("event_type") == "signup") & (_k() < 20)
    parent = F.when(has_parent, F.struct(repo_of(F.col("user_id") % 5).alias("full_name")))
    forkee = F.struct(has_parent.alias("fork"), parent.alias("parent"))
    return events(spark, sf_dir, stream).select(
        F.col("event_id").cast("string").alias("id"),
        _kind().alias("type"),
        F.struct(repo_of(F.col("user_id")).alias("name")).alias("repo"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login")).alias(
            "actor"
        ),
        _created_at().alias("created_at"),
        F.struct(F.when(F.col("event_type") == "signup", forkee).alias("forkee")).alias("payload"),
    )


def archive(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """Archive events, with the columns of the table named by `keep`."""
    return events(spark, sf_dir).select(
        _kind().alias("type"),
        F.struct(repo_of(F.col("user_id")).alias("name")).alias("repo"),
        _created_at().alias("created_at"),
        *keep,
    )


def cut_file(spark: SparkSession, path: str) -> None:
    """Replace a file by its first half, as a transfer that broke off leaves it."""
    apache = spark.sparkContext._jvm.org.apache
    hadoop = apache.hadoop
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    whole, half = (hadoop.fs.Path(f"{path}{end}") for end in ("", ".half"))
    files = whole.getFileSystem(configuration)
    octets = files.getFileStatus(whole).getLen() // 2
    first = apache.commons.io.input.BoundedInputStream(files.open(whole), octets)
    hadoop.io.IOUtils.copyBytes(first, files.create(half, True), 4096, True)
    files.delete(whole, False)
    files.rename(half, whole)


def archive_lines(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """Archive events as JSON lines, broken where `k` is 13, with the columns named by `keep`."""
    kept = events(spark, sf_dir).select(
        *keep,
        _k().alias("k"),
        F.concat(F.lit("{bad "), F.col("event_id").cast("string")).alias("broken"),
        _kind().alias("type"),
        F.struct(repo_of(F.col("user_id")).alias("name")).alias("repo"),
        _created_at().alias("created_at"),
    )
    line = F.to_json(F.struct("type", "repo", "created_at"))
    value = F.when(F.col("k") == 13, F.col("broken")).otherwise(line).alias("value")
    return kept.select(value, *keep)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts read as predictions."""
    return parts(spark, sf_dir).select(
        repo_of(F.col("p_partkey")).alias("name"),
        (F.col("p_size") / 50).alias("probability"),
        F.col("p_type").alias("cluster"),
        (F.col("p_retailprice") - 1000).alias("predicted_growth"),
    )


def _language() -> Column:
    return F.when(F.col("p_type") == UNLABELLED_TYPE, UNKNOWN_LANGUAGE).otherwise(F.col("p_type"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project metadata of every part."""
    return parts(spark, sf_dir).select(
        repo_of(F.col("p_partkey")).alias("repo_name"),
        _language().alias("language"),
        F.floor("p_retailprice").alias("stars_count"),
        F.col("p_size").cast("bigint").alias("forks_count"),
        F.floor("p_retailprice").alias("watchers_count"),
    )


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository dimension of every part."""
    name = repo_of(F.col("p_partkey"))
    return parts(spark, sf_dir).select(
        percent_encoded(name).alias("repo_key"),
        name.alias("full_name"),
        _language().alias("language"),
    )


def tiers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two metadata sources: small parts by brand, some unlabelled, then parts up to size 40."""
    rows = parts(spark, sf_dir).withColumn("repo_name", repo_of(F.col("p_partkey")))
    counts = [
        F.floor("p_retailprice").alias("stars_count"),
        F.col("p_size").cast("bigint").alias("forks_count"),
        F.lit(0).cast("bigint").alias("watchers_count"),
    ]
    brand = F.when(F.col("p_brand") != "Brand#1", F.col("p_brand"))
    return [
        rows.where("p_size <= 20").select("repo_name", brand.alias("language"), *counts),
        rows.where("p_size <= 40").select("repo_name", F.col("p_type").alias("language"), *counts),
    ]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean messages with counts as observed at each event and the project's language."""
    observed = F.floor(F.col("value") * 10)
    has_parent = (F.col("event_type") == "signup") & (_k() < 20)
    number = F.when(has_parent, F.col("user_id") % 5).otherwise(F.col("user_id"))
    found = events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        _kind().alias("event_type"),
        repo_of(number).alias("repo_name"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("actor"),
        observed.alias("stars_count"),
        _k().alias("forks_count"),
        observed.alias("watchers_count"),
        _created_at().alias("created_at"),
    )
    languages = metadata(spark, sf_dir).select("repo_name", "language")
    return (
        relevant(found, "event_type")
        .join(languages, "repo_name", "left")
        .withColumn("language", F.coalesce("language", F.lit(UNKNOWN_LANGUAGE)))
        .select(*schemas.column_names(schemas.MESSAGE))
    )


def timed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with their event time."""
    return messages(spark, sf_dir).withColumn(
        "event_timestamp", stream_time(F.col("created_at"))
    )


def message_lines(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """The topic's text values: every message `copies` times, broken where `k` is 13."""
    text = F.to_json(F.struct(*schemas.column_names(schemas.MESSAGE)))
    value = F.when(F.col("forks_count") == 13, F.lit("{bad")).otherwise(text)
    rows = messages(spark, sf_dir).select(value.alias("value"))
    if copies > 1:
        rows = rows.select("value", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return rows.select("value")


def dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic's text values as in `message_lines`, with the id and time of their event."""
    text = F.to_json(F.struct(*schemas.column_names(schemas.MESSAGE)))
    value = F.when(F.col("forks_count") == 13, F.lit("{bad")).otherwise(text)
    return timed_messages(spark, sf_dir).select("event_id", "event_timestamp", value.alias("value"))


def archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly archive names, one for every hour in which someone signed up."""
    signups = events(spark, sf_dir).where(F.col("event_type") == "signup")
    hours = signups.select(F.date_trunc("hour", "ts").alias("hour")).distinct()
    return hours.select(
        F.concat(
            F.lit("/archive/"),
            F.date_format("hour", "yyyy-MM-dd"),
            F.lit("-"),
            F.hour("hour").cast("string"),
            F.lit(".json.gz"),
        ).alias("path")
    )
