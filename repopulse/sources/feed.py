"""Live feeds: raw event files, the message topic, and message parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.functions.times import stream_time


def raw_event_files(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """Landed API events, one JSON object per line."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schemas.RAW_EVENT).options(**options).json(path)


def topic_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options
) -> DataFrame:
    """Message topic as a stream; needs the Kafka connector on the classpath.

    Messages that expired before they were read fail the stream, unless the option
    `failOnDataLoss` is given as false.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )


def message_files(spark: SparkSession, path: str, stream: bool = True, **options) -> DataFrame:
    """Messages landed as text lines, in the topic's one-column `value` shape."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path)


def parse_messages(feed: DataFrame) -> DataFrame:
    """Flat messages with their event time; broken JSON gives null fields."""
    return (
        feed.select(F.from_json(F.col("value").cast("string"), schemas.MESSAGE).alias("message"))
        .select("message.*")
        .withColumn("event_timestamp", stream_time(F.col("created_at")))
    )
