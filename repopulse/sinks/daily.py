"""Writers of the daily tables (K4-K6, K8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators.enrichment import with_languages
from repopulse.operators.metrics import as_snapshot, last_days, merged_snapshots
from repopulse.session import folder_names, make_folder, matching_paths, remove_folder, staged
from repopulse.sinks.partitions import replace_exactly, replace_partitions, rows_of_days
from repopulse.sources.tables import Tables, processed_days, read_days, read_table

# Source of the counts that a day's own files gave; counts from other days' files name their run.
OWN = "own"
BUCKET = "bucket"
SNAPSHOT_ROWS = f"{schemas.SNAPSHOT}, {BUCKET} string"
#: Sketches of 2 ** 12 registers: a standard error of 1.6 %.
SKETCH_BITS = 12
#: Days of daily rows that are read beside the snapshot before they are folded into it.
FOLD_AFTER = 7


# ---- daily counts per source -----------------------------------------------------------------


def write_counts(
    spark: SparkSession, counts: DataFrame, tables: Tables, run: str | None = None
) -> list[tuple[str, str]]:
    """K4: daily counts with their `source`, replacing what it gave for the day before.

    Returns the days written, each with its source. Days on which an earlier try of
    `run` had strays and this one has none lose those, so a repeated run leaves the
    same table. `counts` should be a written table: it is read for its days and for
    its rows.
    """
    days = counts.select("day", "source").distinct().collect()
    (
        counts.hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "source")
        .parquet(tables.daily_counts)
    )
    found = sorted((row["day"], row["source"]) for row in days)
    if run is not None:
        for path in matching_paths(spark, f"{tables.daily_counts}/day=*/source={run}"):
            day = path.split("/day=")[-1].split("/")[0]
            if (day, run) not in found:
                remove_folder(spark, path)
    return found


def read_counts(spark: SparkSession, tables: Tables, days: Iterable[str]) -> DataFrame:
    """K4: counts of the given days, one row per day, repository and source."""
    return read_days(spark, tables.daily_counts, schemas.DAILY_COUNTS, days)


def read_strays(spark: SparkSession, tables: Tables) -> DataFrame:
    """Counts that came with files of other days, with the run that found them."""
    counts = read_table(spark, tables.daily_counts, schemas.DAILY_COUNTS, first=True)
    return counts.where(F.col("source") != OWN)


def total_counts(counts: DataFrame) -> DataFrame:
    """Counts of all sources together, one row per day and repository."""
    return counts.groupBy("day", "repo_name").agg(
        F.sum("star_count").alias("star_count"),
        F.sum("fork_count").alias("fork_count"),
        F.lit(1).cast("bigint").alias("repo_count"),
        F.sum("total_events").alias("total_events"),
    )


# ---- daily rows ------------------------------------------------------------------------------


def read_weekly(spark: SparkSession, tables: Tables) -> DataFrame:
    """All daily rows, `day` as text although it is the partition column."""
    return read_table(spark, tables.weekly_metrics, schemas.WEEKLY_METRICS, first=True)


def weekly_days(spark: SparkSession, tables: Tables) -> list[str]:
    """Days that have daily rows, from folder names."""
    return folder_names(spark, tables.weekly_metrics, "day=")


def read_weekly_days(spark: SparkSession, tables: Tables, days: Iterable[str]) -> DataFrame:
    """Daily rows of the given days; no other day's folder is listed."""
    return read_days(spark, tables.weekly_metrics, schemas.WEEKLY_METRICS, days)


def write_weekly(spark: SparkSession, rows: DataFrame, tables: Tables, days: list[str]) -> None:
    """K4: replace the given days, the only ones in `rows`; writing them twice changes nothing.

    A day that `rows` has nothing of is emptied. The stars and repositories per
    language of these days are replaced with them, and so are the sketches that
    count distinct repositories over days, so panels over languages read a few
    hundred rows a day. `rows` should be a written table, as it is read twice.
    """
    replace_exactly(spark, rows, tables.weekly_metrics, "day", days)
    totals = rows.groupBy("day", "language").agg(
        F.sum("stars").alias("stars"),
        F.count("*").alias("repos"),
        F.hll_sketch_agg("name", F.lit(SKETCH_BITS)).alias("repo_sketch"),
    )
    replace_exactly(
        spark, staged(spark, totals, "language-days"), tables.language_days, "day", days
    )


def read_language_days(spark: SparkSession, tables: Tables) -> DataFrame:
    """Stars and repositories per day and language."""
    return read_table(spark, tables.language_days, schemas.LANGUAGE_DAYS, first=True)


# ---- last day of every repository ------------------------------------------------------------


def _with_bucket(rows: DataFrame, tables: Tables) -> DataFrame:
    bucket = F.pmod(F.xxhash64("name"), F.lit(tables.snapshot_buckets))
    return rows.withColumn(BUCKET, bucket.cast("string"))


def _buckets_of(rows: DataFrame) -> list[str]:
    return [row[0] for row in rows.select(BUCKET).distinct().collect()]


def _folded(spark: SparkSession, tables: Tables, state: str = "done") -> str:
    """The last day that the stored snapshot includes; empty text before the first fold."""
    return max(folder_names(spark, tables.snapshot_folds, f"{state}="), default="")


def _stored_snapshot(
    spark: SparkSession, tables: Tables, buckets: Iterable[str] | None = None
) -> DataFrame:
    if buckets is None:
        return read_table(spark, tables.snapshots, SNAPSHOT_ROWS, first=True)
    return read_days(spark, tables.snapshots, SNAPSHOT_ROWS, buckets, day=BUCKET)


def read_snapshot(spark: SparkSession, tables: Tables) -> DataFrame:
    """The stored snapshot, brought up to date with the daily rows not folded yet."""
    done = _folded(spark, tables)
    newer = [day for day in weekly_days(spark, tables) if day > done]
    stored = _stored_snapshot(spark, tables).drop(BUCKET)
    return merged_snapshots(stored.unionByName(as_snapshot(read_weekly_days(spark, tables, newer))))


def last_days_before(
    spark: SparkSession, tables: Tables, first_day: str, names: DataFrame
) -> DataFrame:
    """The last stored day before a day of each repository in `names`.

    That is the stored snapshot and the daily rows since. Before a day that the
    snapshot includes already, only repositories that were active on that day or
    later are looked up in the rows of earlier days.
    """
    done = _folded(spark, tables)
    stored = _stored_snapshot(spark, tables).drop(BUCKET).join(names, "name", "left_semi")
    earlier = [day for day in weekly_days(spark, tables) if day < first_day]
    if first_day > done:
        since = read_weekly_days(spark, tables, [day for day in earlier if day > done])
        newer = as_snapshot(since).join(names, "name", "left_semi")
        return merged_snapshots(stored.unionByName(newer))
    active = stored.where(F.col("last_day") >= first_day).select("name")
    history = read_weekly_days(spark, tables, earlier).join(active, "name", "left_semi")
    return stored.where(F.col("last_day") < first_day).unionByName(last_days(history))


def fold_snapshot(spark: SparkSession, tables: Tables) -> None:
    """K5: bring the stored snapshot up to the newest day, in place.

    Only buckets with repositories that were active since are written. A fold that
    was cut off is done again: its rows carry their day, so nothing counts twice.
    """
    done = _folded(spark, tables)
    days = [day for day in weekly_days(spark, tables) if day > done]
    if not days:
        return
    make_folder(spark, f"{tables.snapshot_folds}/begun={days[-1]}")
    newer = _with_bucket(as_snapshot(read_weekly_days(spark, tables, days)), tables)
    stored = _stored_snapshot(spark, tables, _buckets_of(newer))
    merged = merged_snapshots(stored.drop(BUCKET).unionByName(newer.drop(BUCKET)))
    rows = staged(spark, _with_bucket(merged, tables), "snapshot")
    replace_partitions(rows, tables.snapshots, BUCKET)
    make_folder(spark, f"{tables.snapshot_folds}/done={days[-1]}")
    for state in ("begun", "done"):
        for day in folder_names(spark, tables.snapshot_folds, f"{state}="):
            if day < days[-1]:
                remove_folder(spark, f"{tables.snapshot_folds}/{state}={day}")


def finish_fold(spark: SparkSession, tables: Tables) -> None:
    """K5: end a fold that was cut off, before days are compared with it."""
    if _folded(spark, tables, "begun") > _folded(spark, tables):
        fold_snapshot(spark, tables)


def update_snapshot(
    spark: SparkSession, tables: Tables, rows: DataFrame, days: list[str], fold_after: int = FOLD_AFTER
) -> None:
    """K5: after the given days were replaced by `rows`, a written table.

    Days that the snapshot does not include are left to the daily rows, and folded
    in once there are more than `fold_after` of them. So a run writes what its day
    has, and no more than its share of a fold. For days that it includes, those
    buckets are written anew that hold repositories of `rows` or rows of these days;
    a repository that is gone from its last day is looked up in earlier ones.
    """
    done = _folded(spark, tables)
    late = [day for day in days if day <= done]
    if late:
        new = _with_bucket(as_snapshot(rows.where(F.col("day").isin(late))), tables)
        replaced = _stored_snapshot(spark, tables).where(F.col("last_day").isin(late))
        lost = staged(
            spark, replaced.join(new, ["name", "last_day"], "left_anti").select("name"), "lost"
        )
        buckets = sorted({*_buckets_of(new), *_buckets_of(replaced)})
        kept = _stored_snapshot(spark, tables, buckets).where(~F.col("last_day").isin(late))
        found = kept.drop(BUCKET).unionByName(new.drop(BUCKET))
        if not lost.isEmpty():
            folded = [day for day in weekly_days(spark, tables) if day <= done]
            history = read_weekly_days(spark, tables, folded).join(lost, "name", "left_semi")
            found = found.unionByName(as_snapshot(history))
        merged = staged(spark, _with_bucket(merged_snapshots(found), tables), "snapshot")
        replace_exactly(spark, merged, tables.snapshots, BUCKET, buckets)
    if len([day for day in weekly_days(spark, tables) if day > done]) > fold_after:
        fold_snapshot(spark, tables)


# ---- processed days and languages ------------------------------------------------------------


def mark_processed(spark: SparkSession, days: DataFrame, tables: Tables) -> None:
    """K6: add days not listed yet; done last, so a failed run is not marked."""
    fresh = days.select("day").distinct().join(processed_days(spark, tables), "day", "left_anti")
    fresh.write.mode("append").parquet(tables.processed_days)


def rewrite_languages(
    spark: SparkSession, weekly: DataFrame, updates: DataFrame, tables: Tables
) -> None:
    """K8: rewrite only the days that have an update.

    `updates` should be a written table: it is read for the days and for the rows.
    """
    days = [row["day"] for row in updates.select("day").distinct().collect()]
    rows = with_languages(rows_of_days(weekly, updates), updates)
    write_weekly(spark, staged(spark, rows, "languages"), tables, days)
