"""Archive files: selection, reading, coverage and retention."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.functions.text import path_day, path_hour
from repopulse.session import folder_names, matching_paths


def target_day(batch_day: str = "", today: date | None = None) -> str:
    """The requested day, else yesterday in UTC."""
    yesterday = (today or datetime.now(timezone.utc).date()) - timedelta(days=1)
    return batch_day.strip() or yesterday.isoformat()


def archive_paths(
    spark: SparkSession, folder: str, days: Iterable[str]
) -> tuple[list[str], list[str]]:
    """Files of the wanted days, and those of the days that are incomplete.

    The whole-day file if there is one, else the hourly files. Only names are
    listed: a folder holds 25 files per day at most. A folder that does not exist
    is an error, unlike one without new files.
    """
    folder = folder.rstrip("/")
    names = set(folder_names(spark, folder, "", required=True))
    paths, incomplete = [], []
    for day in days:
        hourly = [f"{day}-{hour}.json.gz" for hour in range(24)]
        whole = [name for name in (f"{day}.json.gz",) if name in names]
        taken = whole or [name for name in hourly if name in names]
        paths += [f"{folder}/{name}" for name in taken]
        if not whole and len(taken) < len(hourly):
            incomplete.append(day)
    return paths, incomplete


def read_archive(
    spark: SparkSession, paths: str | list[str], skip_corrupt_files: bool = False
) -> DataFrame:
    """Archive events; unreadable lines keep their text in `_corrupt_record`.

    A truncated file fails the read. `skip_corrupt_files` keeps the rows before
    the damage instead; `damage` tells which files that concerns.
    """
    return (
        spark.read.schema(f"{schemas.ARCHIVE_EVENT}, {schemas.CORRUPT_COLUMN} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN)
        .option("ignoreCorruptFiles", str(skip_corrupt_files).lower())
        .json(paths)
    )


def gzip_octets(spark: SparkSession, path: str) -> int:
    """Octets of a compressed file's content modulo 2 ** 32, as its end states them; -1 without an end."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    length = files.getFileStatus(name).getLen()
    if length < 4:
        return -1
    content = files.open(name)
    try:
        content.seek(length - 4)
        return int.from_bytes(struct.pack(">i", content.readInt()), "little")
    finally:
        content.close()


def damage(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file its day, the lines and octets that can be read, those it should have, and is_whole.

    A file is whole if what was read is as long as its end states; a cut-off file
    ends in something else. Lines end in a line feed and files have one compressed
    member. The driver reads four octets a file, of 25 files a day at most.
    """
    names = [n for p in paths for n in matching_paths(spark, f"{p}/*.gz") or [p]]
    stated = [(n, path_day_of(n), gzip_octets(spark, n)) for n in names]
    files = spark.createDataFrame(stated, "path string, day string, octets long")
    lines = spark.read.option("ignoreCorruptFiles", "true").text(paths)
    read = lines.groupBy(F.col("_metadata.file_path").alias("found")).agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).alias("octets_read")
    )
    # Both name the same file, with and without the scheme's empty host.
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    joined = files.join(read, plain(F.col("path")) == plain(F.col("found")), "left")
    octets_read = F.coalesce("octets_read", F.lit(0))
    # The last line may lack its line feed.
    has_end = F.col("octets") >= 0
    is_whole = has_end & F.pmod(octets_read, F.lit(1 << 32)).isin(F.col("octets"), F.col("octets") + 1)
    return joined.select(
        "path",
        "day",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        octets_read.alias("octets_read"),
        "octets",
        is_whole.alias("is_whole"),
    )


def path_day_of(path: str) -> str | None:
    """The first date in a path."""
    found = re.search(r"\d{4}-\d{2}-\d{2}", path)
    return found and found.group()


def readable(archive: DataFrame) -> DataFrame:
    """Rows that were valid JSON."""
    return archive.where(F.col(schemas.CORRUPT_COLUMN).isNull()).drop(schemas.CORRUPT_COLUMN)


def quarantined(archive: DataFrame) -> DataFrame:
    """Text of unreadable lines with their file and whatever type was parsed."""
    path = F.col("path") if "path" in archive.columns else F.input_file_name()
    return archive.select(
        path.alias("path"), "type", F.col(schemas.CORRUPT_COLUMN).alias("record")
    ).where(F.col("record").isNotNull())


def list_files(spark: SparkSession, folder: str, pattern: str = "*.json.gz") -> DataFrame:
    """File names of a folder as a table; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path")


def archive_coverage(paths: DataFrame, days: DataFrame) -> DataFrame:
    """Per wanted day whether a whole-day file or all 24 hourly files exist.

    Hours are at most 24 per day, so the per-day set stays small however many
    paths there are.
    """
    found = (
        paths.select(path_day(F.col("path")).alias("day"), F.col("path"))
        .where(F.col("path").endswith(".json.gz"))
        .groupBy("day")
        .agg(
            F.max(F.col("path").rlike(r"/\d{4}-\d{2}-\d{2}\.json\.gz$")).alias("whole_day"),
            F.collect_set(path_hour(F.col("path"))).alias("hours"),
        )
    )
    wanted = days.select("day").distinct().join(found, "day", "left")
    whole_day = F.coalesce(F.col("whole_day"), F.lit(False))
    missing = F.array_except(
        F.sequence(F.lit(0), F.lit(23)), F.coalesce("hours", F.array().cast("array<int>"))
    )
    return wanted.select(
        "day",
        whole_day.alias("whole_day"),
        F.when(whole_day, F.array().cast("array<int>")).otherwise(missing).alias("missing_hours"),
    ).withColumn("complete", F.size("missing_hours") == 0)


def missing_hours(coverage: DataFrame) -> DataFrame:
    """One row per hour that no file covers."""
    return coverage.select("day", F.explode("missing_hours").alias("hour"))


def expired_files(paths: DataFrame, today: str, retention_days: int = 30) -> DataFrame:
    """Files dated strictly before the cutoff; undated paths are kept.

    Deleting them is the caller's decision.
    """
    cutoff = F.date_sub(F.lit(today).cast("date"), retention_days).cast("string")
    return (
        paths.select("path", path_day(F.col("path")).alias("day"))
        .where(F.col("path").endswith(".json.gz"))
        .where(F.col("day") < cutoff)
    )
