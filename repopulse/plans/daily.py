"""The daily batch and the language backfill (Q4, Q5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.functions.text import path_day
from repopulse.operators.cleaning import FORK_EVENT, STAR_EVENT, archive_events
from repopulse.operators.enrichment import enrich_repos, language_updates
from repopulse.operators.metrics import (
    daily_metrics,
    daily_velocity,
    incremental_velocity,
    unprocessed,
)
from repopulse.session import remove_folder
from repopulse.session import staged as staged_rows
from repopulse.sinks.daily import (
    OWN,
    finish_fold,
    last_days_before,
    mark_processed,
    read_counts,
    read_weekly,
    read_weekly_days,
    rewrite_languages,
    total_counts,
    update_snapshot,
    weekly_days,
    write_counts,
    write_weekly,
)
from repopulse.sinks.live import read_repos
from repopulse.sinks.partitions import replace_exactly
from repopulse.sinks.rows import weekly_rows
from repopulse.sources.archive import (
    archive_paths,
    damage,
    quarantined,
    read_archive,
    readable,
    target_day,
)
from repopulse.sources.tables import Tables, processed_days


def weekly_metrics(
    daily: DataFrame,
    repos: DataFrame,
    tiers: Sequence[DataFrame] = (),
    snapshot: DataFrame | None = None,
) -> DataFrame:
    """Q4 from daily counts to enriched daily rows.

    Without a snapshot, velocity looks only at the days of the input.
    """
    moving = daily_velocity(daily) if snapshot is None else incremental_velocity(daily, snapshot)
    return weekly_rows(enrich_repos(moving, repos, tiers))


def top_velocity(weekly: DataFrame, limit: int = 10) -> DataFrame:
    """Rows that gained most, then by name and day."""
    return weekly.orderBy(F.col("velocity").desc(), "name", "day").limit(limit)


def run_daily(
    spark: SparkSession,
    tables: Tables,
    archive: DataFrame,
    tiers: Sequence[DataFrame] = (),
    carry_in: bool = True,
    reprocess: bool = False,
    incomplete_days: DataFrame | None = None,
    days: Sequence[str] | None = None,
    strays: bool = False,
) -> bool:
    """Q4: process new days into the daily tables; True if there were any.

    `days` are the days the run is asked for, by default all that occur. Finished
    days are skipped unless `reprocess`, and so are events of other days, unless
    `strays` says that `archive` holds the files of `days` and nothing else. Then
    counts of other days are kept under the run's name, are added to their day's
    rows if that is stored or once it is, and never mark a day done. Repeating a
    run replaces its strays, so none counts twice.

    With `carry_in`, velocity of the first new day follows the stored last day;
    without it, every run starts from zero. Days in `incomplete_days` are written
    but not marked, so a later run picks them up again. Velocities of the next
    active day after one that comes late or again are computed anew in the same
    run. The archive is read once: its daily counts are written and every later step
    starts from them.
    """
    counts = daily_metrics(archive_events(archive)).drop("repo_count")
    source, run = F.lit(OWN), None
    if days is None:
        if not reprocess:
            counts = unprocessed(counts, processed_days(spark, tables))
    else:
        finished = [] if reprocess else _finished(spark, tables, days)
        counts = counts.where(~F.col("day").isin(finished))
        if strays:
            run = f"{min(days, default='none')}..{max(days, default='none')}"
            source = F.when(F.col("day").isin(list(days)), OWN).otherwise(run)
        else:
            counts = counts.where(F.col("day").isin(list(days)))
    counts = staged_rows(spark, counts.withColumn("source", source), "daily")
    found = write_counts(spark, counts, tables, run)
    asked = sorted(day for day, its_source in found if its_source == OWN)
    stored = weekly_days(spark, tables)
    emptied = set(days or []).intersection(stored).difference(asked) if reprocess else set()
    for day in emptied:
        remove_folder(spark, f"{tables.daily_counts}/day={day}/source={OWN}")
    elsewhere = {day for day, its_source in found if its_source != OWN}
    touched = sorted({*asked, *elsewhere.intersection(stored), *emptied})
    if not touched:
        return False

    finish_fold(spark, tables)
    totals = total_counts(read_counts(spark, tables, touched))
    names = totals.select(F.col("repo_name").alias("name"))
    again = set(touched).intersection(stored)
    if again:
        # Repositories that lose their row of a day matter to the days after it.
        names = names.unionByName(read_weekly_days(spark, tables, again).select("name"))
        names = staged_rows(spark, names.distinct(), "names")
    snapshot = last_days_before(spark, tables, touched[0], names) if carry_in else None
    rows = weekly_metrics(totals, read_repos(spark, tables), tiers, snapshot)
    written = staged_rows(spark, rows, "weekly")
    write_weekly(spark, written, tables, touched)
    if carry_in and [day for day in stored if day > touched[0] and day not in touched]:
        refresh_later_velocity(spark, tables, touched[0], names)
    update_snapshot(spark, tables, written, touched)
    finished = spark.createDataFrame([(day,) for day in asked], "day string")
    if incomplete_days is not None:
        finished = finished.join(incomplete_days, "day", "left_anti")
    mark_processed(spark, finished, tables)
    return bool(asked)


def _finished(spark: SparkSession, tables: Tables, days: Sequence[str]) -> list[str]:
    done = processed_days(spark, tables).where(F.col("day").isin(list(days)))
    return [row["day"] for row in done.collect()]


def refresh_later_velocity(
    spark: SparkSession, tables: Tables, first_day: str, names: DataFrame
) -> None:
    """Velocities of the named repositories from `first_day` on, where they no longer follow.

    Only rows of these repositories are read for it, of the days since, and only
    days on which some differ are rewritten.
    """
    since = [day for day in weekly_days(spark, tables) if day >= first_day]
    counts = (
        read_weekly_days(spark, tables, since)
        .join(names, "name", "left_semi")
        .select(
            F.col("name").alias("repo_name"), "day", F.col("stars").alias("star_count"),
            F.col("forks").alias("fork_count"), F.col("velocity").alias("old_velocity"),
            F.col("fork_velocity").alias("old_fork_velocity"),
        )
    )
    again = incremental_velocity(counts, last_days_before(spark, tables, first_day, names))
    differs = (F.col("velocity") != F.col("old_velocity")) | (
        F.col("fork_velocity") != F.col("old_fork_velocity")
    )
    changed = staged_rows(
        spark,
        again.where(differs).select(
            F.col("repo_name").alias("name"),
            "day",
            F.col("velocity").alias("new_velocity"),
            F.col("fork_velocity").alias("new_fork_velocity"),
        ),
        "velocity",
    )
    stale = [row["day"] for row in changed.select("day").distinct().collect()]
    if stale:
        rows = read_weekly_days(spark, tables, stale)
        fresh = rows.join(changed, ["name", "day"], "left").withColumns(
            {
                "velocity": F.coalesce("new_velocity", "velocity"),
                "fork_velocity": F.coalesce("new_fork_velocity", "fork_velocity"),
            }
        )
        fresh = staged_rows(spark, fresh.select(*rows.columns), "fresh")
        write_weekly(spark, fresh, tables, stale)


def run_archive(
    spark: SparkSession,
    tables: Tables,
    folder: str,
    days: Sequence[str] | None = None,
    tiers: Sequence[DataFrame] = (),
    metadata: DataFrame | None = None,
    skip_corrupt_files: bool = False,
    quarantine: bool = False,
    reprocess: bool = False,
    **options,
) -> bool:
    """Q4 from archive files; when nothing is new, backfill languages instead (Q5).

    A folder that does not exist is an error, as nothing can be new in it. `days` defaults to yesterday. Files of finished days are not read at all. Of a
    day with a whole-day file only that is read, else its hourly files; a day with
    hours missing is written but not marked. With `skip_corrupt_files`, what can be
    read of a damaged file counts, the file is listed in `damaged_files`, and its
    day is not marked. With `quarantine`, star and fork
    events and unreadable lines are taken out of the files in one pass, and the
    latter replace what the quarantine holds of their files' days.
    """
    wanted = [target_day()] if days is None else list(days)
    if not reprocess:
        wanted = sorted(set(wanted).difference(_finished(spark, tables, wanted)))
    paths, incomplete = archive_paths(spark, folder, wanted)
    if not paths:
        if metadata is not None:
            run_backfill(spark, tables, metadata)
        return False
    archive = read_archive(spark, paths, skip_corrupt_files)
    if skip_corrupt_files:
        broken = staged_rows(spark, damage(spark, paths).where(~F.col("is_whole")), "damage")
        replace_exactly(spark, broken, tables.damaged_files, "day", wanted)
        incomplete += [row["day"] for row in broken.select("day").distinct().collect()]
    if quarantine:
        kind = F.col("type")
        kept = archive.withColumn("path", F.input_file_name()).where(
            (kind == STAR_EVENT)
            | (kind == FORK_EVENT)
            | F.col(schemas.CORRUPT_COLUMN).isNotNull()
        )
        archive = staged_rows(spark, kept, "archive")
        lines = quarantined(archive).withColumn("day", path_day(F.col("path")))
        lines = staged_rows(spark, lines, "quarantine")
        replace_exactly(spark, lines, tables.quarantine, "day", wanted)
    if incomplete:
        options["incomplete_days"] = spark.createDataFrame([(d,) for d in incomplete], "day string")
    ran = run_daily(
        spark,
        tables,
        readable(archive),
        tiers,
        reprocess=reprocess,
        days=wanted,
        strays=True,
        **options,
    )
    if not ran and metadata is not None:
        run_backfill(spark, tables, metadata)
    return ran


def run_backfill(spark: SparkSession, tables: Tables, metadata: DataFrame) -> None:
    """Q5: fill missing languages of stored daily rows, rewriting only days that change."""
    weekly = read_weekly(spark, tables)
    updates = language_updates(weekly, read_repos(spark, tables), metadata)
    staged = staged_rows(spark, updates, "backfill")
    if not staged.isEmpty():
        rewrite_languages(spark, weekly, staged, tables)
