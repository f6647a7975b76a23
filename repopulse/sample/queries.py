"""One query per operator and end-to-end capability, over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.functions import numbers, text, times
from repopulse.operators import cleaning, enrichment, metrics
from repopulse.plans import breakout, daily, dashboard, panels
from repopulse.sample import tables as sample
from repopulse.session import configure, matching_paths, run_dir, staged, stream_session
from repopulse.sinks import live, rows
from repopulse.sinks.daily import read_snapshot, read_weekly
from repopulse.sources import archive as archive_files
from repopulse.sources import tables as stored
from repopulse.sources.feed import message_files, parse_messages, raw_event_files
from repopulse.sources.tables import Tables
from repopulse.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]

# ---- cleaning ------------------------------------------------------------------------------


def relevant_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = cleaning.archive_events(sample.archive(spark, sf_dir))
    return events.withColumn("day", F.col("day").cast("string"))


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = cleaning.resolve_raw_events(sample.raw_events(spark, sf_dir))
    return enrichment.attach_metadata(events, sample.metadata(spark, sf_dir)).drop(
        "event_timestamp"
    )


def fork_canonicalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.raw_events(spark, sf_dir)
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("repo.name").alias("own_repo"),
        cleaning.canonical_repo().alias("repo_name"),
    )


def raw_file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events landed as JSON lines and read back as files."""
    path = f"{run_dir(spark, 'raw-events')}/landed"
    sample.raw_events(spark, sf_dir).write.json(path)
    return cleaning.resolve_raw_events(raw_event_files(spark, path)).drop("event_timestamp")


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = cleaning.resolve_raw_events(sample.raw_events(spark, sf_dir)).drop("event_timestamp")
    return cleaning.distinct_events(once.unionAll(once))


def validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sample.message_lines(spark, sf_dir)
    return cleaning.valid_messages(parse_messages(lines)).drop("event_timestamp")


def message_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = rows.message_values(sample.messages(spark, sf_dir))
    fields = (field.split() for field in schemas.MESSAGE.split(", "))
    return values.select(
        *(F.get_json_object("value", f"$.{name}").cast(kind).alias(name) for name, kind in fields)
    )


# ---- live windows --------------------------------------------------------------------------


# Windows in which enough repositories are active for a full ranking.
PANEL_WIDTH = "1 day"


def _batch_windows(
    spark: SparkSession, sf_dir: str, width: str = metrics.WINDOW_WIDTH
) -> DataFrame:
    return metrics.windowed_activity(sample.timed_messages(spark, sf_dir), width)


def _live_rows(
    spark: SparkSession, sf_dir: str, width: str = metrics.WINDOW_WIDTH
) -> DataFrame:
    return rows.live_metrics_rows(_batch_windows(spark, sf_dir, width))


def windowed_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_windows(spark, sf_dir)


def live_metrics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_rows(spark, sf_dir)


def live_metrics_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.newest_live_metrics(_live_rows(spark, sf_dir), 20)


def repos_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.first_seen_repos(_live_rows(spark, sf_dir))


def repos_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star events first, then fork events add the repositories still missing."""
    live_rows = _live_rows(spark, sf_dir)
    stars = enrichment.first_seen_repos(live_rows.where("event_type = 'WatchEvent'"))
    forks = enrichment.first_seen_repos(live_rows.where("event_type = 'ForkEvent'"))
    return stars.unionByName(enrichment.absent_repos(forks, stars))


def _landed_feed(spark: SparkSession, sf_dir: str, folder: str, copies: int = 1) -> DataFrame:
    """All messages landed as text files, read back as a stream."""
    path = f"{folder}/landed"
    sample.message_lines(spark, sf_dir, copies).write.text(path)
    return message_files(stream_session(spark), path)


def _run_stream(spark: SparkSession, sf_dir: str, label: str, copies: int, **windows) -> Tables:
    folder = run_dir(spark, label)
    tables = Tables(f"{folder}/tables")
    streams.stream_live_metrics(
        _landed_feed(spark, sf_dir, folder, copies),
        tables,
        f"{folder}/checkpoints/live-metrics",
        every=None,
        **windows,
    ).awaitTermination()
    return tables


def stream_windowed_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's live table after one pass over all messages."""
    tables = _run_stream(spark, sf_dir, "stream", copies=1)
    return live.read_live_metrics(spark, tables)


def stream_dedup_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every message delivered twice and duplicates dropped."""
    tables = _run_stream(spark, sf_dir, "stream-dedup", copies=2, drop_duplicates=True)
    return live.read_live_metrics(spark, tables)


def _land(spark: SparkSession, sf_dir: str, path: str, batch: int) -> None:
    """One batch of messages: ten days each, one event in twenty a batch later."""
    lines = sample.dated_lines(spark, sf_dir)
    late = F.pmod(F.col("event_id").cast("bigint"), F.lit(20)) == 0
    number = F.least(F.floor((F.dayofmonth("event_timestamp") - 1) / 10), F.lit(2))
    number = number + F.when(late, 1).otherwise(0)
    lines.where(number == batch).select("value").write.mode("append").text(path)


def _repos_tables(spark: SparkSession, sf_dir: str, label: str) -> Tables:
    """The repository log after four starts of its stream, each on what has come since."""
    folder = run_dir(spark, label)
    tables = Tables(f"{folder}/tables")
    for batch in range(4):
        _land(spark, sf_dir, f"{folder}/landed", batch)
        streams.stream_repos(
            message_files(stream_session(spark), f"{folder}/landed"),
            tables,
            f"{folder}/checkpoints/repos",
            every=None,
        ).awaitTermination()
    return tables


def stream_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository dimension that the stream fills over several starts."""
    return live.read_repos(spark, _repos_tables(spark, sf_dir, "stream-repos"))


def stream_repos_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the same log names each repository, before and after folding."""
    tables = _repos_tables(spark, sf_dir, "stream-repos-log")
    logged = staged(spark, spark.read.parquet(tables.repos), "log")
    live.remove_folded(spark, tables, live.compact_repos(spark, tables, "1"))
    times = logged.groupBy("full_name").agg(F.count("*").alias("logged"))
    return live.read_repos(spark, tables).join(times, "full_name").select("full_name", "logged")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live table after four micro-batches whose late rows are dropped once their window has closed."""
    folder = run_dir(spark, "stream-late")
    tables = Tables(f"{folder}/tables")
    for batch in range(4):
        _land(spark, sf_dir, f"{folder}/landed", batch)
        streams.stream_live_metrics(
            message_files(stream_session(spark), f"{folder}/landed"),
            tables,
            f"{folder}/checkpoints/late",
            every=None,
            delay="2 days",
        ).awaitTermination()
    return live.read_live_metrics(spark, tables)


def stream_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live table of a stream each of whose batches failed once, after it was written."""
    folder = run_dir(spark, "stream-recovered")
    tables = Tables(f"{folder}/tables")
    failed = set()

    def attempt(feed: DataFrame) -> None:
        store = live.upsert_live_batch(tables)

        def write(batch: DataFrame, batch_id: int) -> None:
            store(batch, batch_id)
            if batch_id not in failed:
                failed.add(batch_id)
                raise OSError("the connection was lost after the write")

        windows = streams.live_windows(feed, delay="60 days")
        checkpoint = f"{folder}/checkpoints/recovered"
        streams.start(windows, write, checkpoint, every=None, mode="update").awaitTermination()

    for batch in range(4):
        _land(spark, sf_dir, f"{folder}/landed", batch)
        feed = message_files(stream_session(spark), f"{folder}/landed")
        try:
            attempt(feed)
        except StreamingQueryException:
            attempt(feed)
    return live.read_live_metrics(spark, tables)


def stream_live_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "stream-feed")
    tables = Tables(f"{folder}/tables")
    landed = _landed_feed(spark, sf_dir, folder)
    streams.stream_live_events(
        landed, tables, f"{folder}/checkpoints/feed", every=None
    ).awaitTermination()
    return live.read_live_events(spark, tables).drop("day")


def stream_live_feed_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed table after two streams with a checkpoint each, over half of the messages each."""
    folder = run_dir(spark, "stream-restart")
    tables = Tables(f"{folder}/tables")
    lines = sample.message_lines(spark, sf_dir)
    for half in (0, 1):
        path = f"{folder}/landed-{half}"
        lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half).write.text(path)
        streams.stream_live_events(
            message_files(stream_session(spark), path),
            tables,
            f"{folder}/checkpoints/feed-{half}",
            every=None,
        ).awaitTermination()
    return live.read_live_events(spark, tables).drop("day")


def stream_canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events, each delivered twice, cleaned by the publishing stream."""
    session = stream_session(spark)
    folder = run_dir(spark, "stream-publish")
    tables = Tables(f"{folder}/tables")
    raw = sample.raw_events(session, sf_dir, stream=True)
    twice = raw.select("*", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    streams.publish_messages(
        twice,
        sample.metadata(session, sf_dir),
        tables,
        f"{folder}/checkpoints/publish",
        every=None,
    ).awaitTermination()
    published = parse_messages(spark.read.text(tables.messages))
    return published.drop("event_timestamp")


# ---- daily metrics -------------------------------------------------------------------------


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_metrics(cleaning.archive_events(sample.archive(spark, sf_dir)))


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.weekly_metrics(
        _daily(spark, sf_dir), sample.repos(spark, sf_dir), sample.tiers(spark, sf_dir)
    )


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir)


def daily_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_velocity(_daily(spark, sf_dir))


def incremental_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day alone, carried in from the snapshot of all days before it."""
    counts = staged(spark, _daily(spark, sf_dir), "daily-counts")
    last = counts.agg(F.max("day")).scalar()
    before = rows.weekly_rows(_plain_weekly(counts.where(F.col("day") < last)))
    newest = counts.where(F.col("day") == last)
    return metrics.incremental_velocity(newest, metrics.last_days(before))


def _plain_weekly(daily_counts: DataFrame) -> DataFrame:
    nothing = {name: F.lit(None).cast("bigint") for name in ("velocity", "fork_velocity")}
    counts = {name: F.lit(None).cast("bigint") for name in ("api_stars", "api_forks")}
    return daily_counts.withColumns({**nothing, **counts, "language": F.lit(None).cast("string")})


def last_day_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.last_days(_weekly(spark, sf_dir))


def unprocessed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of the days without an error in their first hour, taken as not done."""
    early_errors = (F.col("event_type") == "error") & (F.hour("ts") == 0)
    done = sample.events(spark, sf_dir).where(early_errors).select(
        F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    return metrics.unprocessed(_daily(spark, sf_dir), done)


def top_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.top_velocity(_weekly(spark, sf_dir)).select("name", "day", "stars", "velocity")


def distinct_repos_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_repos_by_language(_weekly(spark, sf_dir))


# ---- enrichment ----------------------------------------------------------------------------


def language_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.language_lookup(sample.repos(spark, sf_dir))


def precedence_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sample.repos(spark, sf_dir).select(F.col("full_name").alias("repo_name"))
    return enrichment.enrich_repos(
        names, sample.repos(spark, sf_dir), sample.tiers(spark, sf_dir)
    )


def weekly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(spark, sf_dir)


def language_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows enriched by the dimension alone, then filled from the second source."""
    repos = sample.repos(spark, sf_dir)
    weekly = staged(spark, daily.weekly_metrics(_daily(spark, sf_dir), repos), "weekly")
    source = sample.tiers(spark, sf_dir)[1]
    updates = enrichment.language_updates(weekly, repos, source)
    return enrichment.with_languages(weekly, updates)


def _two_runs(spark: SparkSession, sf_dir: str, label: str) -> Tables:
    """The daily tables after two runs: all days but the last, then the last with carry-in."""
    tables = Tables(f"{run_dir(spark, label)}/tables")
    _store_repos(spark, sf_dir, tables)
    archive = sample.archive(spark, sf_dir)
    day = times.day_text(times.archive_time(F.col("created_at")))
    last = archive.agg(F.max(day)).scalar()
    tiers = sample.tiers(spark, sf_dir)
    daily.run_daily(spark, tables, archive.where(day < last), tiers)
    daily.run_daily(spark, tables, archive, tiers)
    return tables


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_weekly(spark, _two_runs(spark, sf_dir, "daily-job"))


def snapshot_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshot(spark, _two_runs(spark, sf_dir, "snapshot-job"))


def processed_days_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(f"{run_dir(spark, 'processed-job')}/tables")
    daily.run_daily(spark, tables, sample.archive(spark, sf_dir))
    return stored.processed_days(spark, tables)


def backfill_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table after a run without metadata and a backfill."""
    tables = Tables(f"{run_dir(spark, 'backfill-job')}/tables")
    _store_repos(spark, sf_dir, tables)
    daily.run_daily(spark, tables, sample.archive(spark, sf_dir))
    daily.run_backfill(spark, tables, sample.tiers(spark, sf_dir)[1])
    return read_weekly(spark, tables)


def daily_job_doubled_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows where the dimension and every source hold each row twice."""
    twice = lambda rows: rows.unionAll(rows)
    return daily.weekly_metrics(
        _daily(spark, sf_dir),
        twice(sample.repos(spark, sf_dir)),
        [twice(tier) for tier in sample.tiers(spark, sf_dir)],
    )


def daily_job_stray_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table after a run over all events that was asked for all days but the last."""
    tables = Tables(f"{run_dir(spark, 'stray-job')}/tables")
    _store_repos(spark, sf_dir, tables)
    days = sorted(row["day"] for row in _event_days(spark, sf_dir).collect())
    tiers = sample.tiers(spark, sf_dir)
    daily.run_daily(spark, tables, sample.archive(spark, sf_dir), tiers, days=days[:-1])
    done = stored.processed_days(spark, tables)
    return read_weekly(spark, tables).join(done, "day", "left_semi").select(
        *schemas.column_names(schemas.WEEKLY_METRICS)
    )


def stray_events_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table where a tenth of each ten days' events came with later days' files.

    The days are finished by then, and the last run is repeated.
    """
    tables = Tables(f"{run_dir(spark, 'stray-events')}/tables")
    _store_repos(spark, sf_dir, tables)
    tiers = sample.tiers(spark, sf_dir)
    days = sorted(row["day"] for row in _event_days(spark, sf_dir).collect())
    events = sample.archive(spark, sf_dir, keep=["event_id", "ts"])
    own = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    came = F.least(own + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0), F.lit(2))
    for number in (0, 1, 2, 2):
        asked = [d for d in days if min((int(d[8:]) - 1) // 10, 2) == number]
        files = events.where(came == number).drop("event_id", "ts")
        daily.run_daily(spark, tables, files, tiers, days=asked, reprocess=True, strays=True)
    return read_weekly(spark, tables)


def daily_job_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table of the first day, whose whole-day file and hourly files both exist."""
    folder = run_dir(spark, "mixed-files")
    tables = Tables(f"{folder}/tables")
    lines = sample.archive_lines(spark, sf_dir)
    day = _event_days(spark, sf_dir).agg(F.min("day")).first()[0]
    of_day = lines.where(F.contains("value", F.lit(day)))
    for name in (f"{day}.json.gz", f"{day}-9.json.gz", f"{day}-10.json.gz"):
        of_day.write.option("compression", "gzip").text(f"{folder}/files/{name}")
    daily.run_archive(spark, tables, f"{folder}/files", [day])
    return read_weekly(spark, tables).select("name", "day", "stars", "forks", "velocity")


def late_day_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table after all days but one, and then that one."""
    tables = Tables(f"{run_dir(spark, 'late-job')}/tables")
    _store_repos(spark, sf_dir, tables)
    archive = sample.archive(spark, sf_dir)
    tiers = sample.tiers(spark, sf_dir)
    days = sorted(row["day"] for row in _event_days(spark, sf_dir).collect())
    late = days[len(days) // 2]
    daily.run_daily(spark, tables, archive, tiers, days=[day for day in days if day != late])
    daily.run_daily(spark, tables, archive, tiers, days=[late])
    return read_weekly(spark, tables)


def dashboard_rising_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dashboard(spark, _two_runs(spark, sf_dir, "panels"))["rising_languages"]


def dashboard_historical_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dashboard(spark, _two_runs(spark, sf_dir, "panels"))["historical_trends"]


def dashboard_trending_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dashboard(spark, _two_runs(spark, sf_dir, "panels"))["trending_daily"]


def dashboard_trending_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live panel over the tables of a stream, with its new-entrant flag."""
    tables = _run_stream(spark, sf_dir, "stream-panel", copies=1, width=PANEL_WIDTH)
    return dashboard.dashboard(spark, tables)["trending_now"]


def _store_repos(spark: SparkSession, sf_dir: str, tables: Tables) -> None:
    sample.repos(spark, sf_dir).write.parquet(live.batch_path(tables.repos, "none", 0))


def _archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole archive written as compressed JSON lines and read back by its year."""
    folder = run_dir(spark, "archive")
    lines = sample.archive_lines(spark, sf_dir)
    lines.write.option("compression", "gzip").text(f"{folder}/2024-01-01.json.gz")
    paths, _ = archive_files.archive_paths(spark, folder, ["2024-01-01"])
    return archive_files.read_archive(spark, paths)


def archive_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of the readable lines of the archive files."""
    lines = archive_files.readable(_archive_files(spark, sf_dir))
    return metrics.daily_metrics(cleaning.archive_events(lines))


def archive_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unreadable lines of the archive files."""
    return archive_files.quarantined(_archive_files(spark, sf_dir)).select("type", "record")


# ---- panels --------------------------------------------------------------------------------


def trending_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.trending_now(_live_rows(spark, sf_dir, PANEL_WIDTH))


def trending_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking with a flag for repositories that the window before did not rank."""
    live_rows = _live_rows(spark, sf_dir, PANEL_WIDTH)
    return panels.with_new_flag(
        panels.trending_now(live_rows), panels.trending_window(live_rows, nth=2)
    )


def new_entrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    live_rows = _live_rows(spark, sf_dir, PANEL_WIDTH)
    return panels.new_entrants(
        panels.trending_window(live_rows), panels.trending_window(live_rows, nth=2)
    )


def rising_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.rising_languages(_weekly(spark, sf_dir))


def language_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = panels.language_days(_weekly(spark, sf_dir))
    return per_day.withColumn("day", F.col("day").cast("string"))


def language_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.language_totals(_weekly(spark, sf_dir))


def activity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = rows.live_event_rows(sample.timed_messages(spark, sf_dir))
    return panels.activity_feed(events)


def historical_trends_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.historical_long(_weekly(spark, sf_dir))


def historical_trends_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.historical_slots(_weekly(spark, sf_dir))


def trending_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.trending_daily(_weekly(spark, sf_dir))


def breakout_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakout.scored_days(_weekly(spark, sf_dir))


def breakout_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per repository: whether its scores are what they must be."""
    return breakout_scores(spark, sf_dir).select(
        "name",
        F.col("probability").between(0, 1).alias("is_probability"),
        F.col("cluster").isin(*(f"cluster-{i}" for i in range(4))).alias("is_cluster"),
        (~F.isnan("predicted_growth") & (F.abs("predicted_growth") < 1e9)).alias("is_growth"),
    )


def breakout_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakout.breakout_scores(spark, _weekly(spark, sf_dir))


def weekly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.newest_weekly_metrics(_weekly(spark, sf_dir), 200)


def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan by key prefix: the last rows of the days from the 10th to the 19th."""
    return stored.scan(_weekly(spark, sf_dir), 100, prefix="2024-01-1", latest_first=True)


def insight_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prediction panel over parts read as predictions."""
    return panels.ai_insights(sample.predictions(spark, sf_dir))


def ai_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel over stored predictions, made by models that were stored before."""
    tables = Tables(f"{run_dir(spark, 'insights')}/tables")
    weekly = staged(spark, _weekly(spark, sf_dir), "weekly")
    last = weekly.agg(F.max("day")).scalar()
    breakout.refresh_predictions(spark, tables, weekly.where(F.col("day") < last))
    breakout.refresh_predictions(spark, tables, weekly, refit=False)
    return dashboard.dashboard(spark, tables)["ai_insights"]


def breakout_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest over the last days: what was rated, and whether the figures are what they must be."""
    weekly = staged(spark, _weekly(spark, sf_dir), "weekly")
    return breakout.backtest(spark, weekly).select(
        "day",
        "repos",
        "grew",
        (F.col("hits").between(0, F.col("repos"))).alias("hits_fit"),
        ((F.col("log_loss") >= 0) & (F.col("growth_error") >= 0)).alias("errors_fit"),
    )


def distinct_repos_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct repositories per language over all stored days but the first, and the sketches' error."""
    tables = _two_runs(spark, sf_dir, "distinct-repos")
    days = stored.newest_days(spark, tables.language_days, 1 << 30)[1:]
    rollup = stored.read_days(spark, tables.language_days, schemas.LANGUAGE_DAYS, days)
    about = metrics.merged_distinct_repos(rollup).withColumnRenamed("repos", "about")
    exact = read_weekly(spark, tables).where(F.col("day").isin(days)).groupBy("language")
    counted = exact.agg(F.count_distinct("name").alias("repos"))
    # Three standard errors.
    is_close = F.abs(F.col("about") - F.col("repos")) <= F.greatest(0.05 * F.col("repos"), F.lit(1))
    return counted.join(about, "language").select("language", "repos", is_close.alias("is_close"))


def archive_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three archive files of ten days each, of which the second is cut off in the middle."""
    folder = run_dir(spark, "damage")
    lines = sample.archive_lines(spark, sf_dir, keep=["ts"])
    number = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    names = [f"{folder}/2024-01-{day}.json.gz" for day in ("01", "11", "21")]
    for place, name in enumerate(names):
        part = lines.where(number == place).select("value")
        part.write.option("compression", "gzip").text(name)
    for file in matching_paths(spark, f"{names[1]}/*.gz"):
        sample.cut_file(spark, file)
    found = archive_files.damage(spark, names)
    per_file = found.groupBy("day").agg(F.every("is_whole").alias("is_whole"), F.sum("lines").alias("lines"))
    return per_file.select("day", "is_whole", F.when(F.col("is_whole"), F.col("lines")).alias("lines"))


# ---- scalar functions and files ------------------------------------------------------------


def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sample.events(spark, sf_dir)
    value = F.col("value").cast("string")
    signed = F.concat(F.lit(" -"), F.format_string("%.2f", "value"), F.lit(" "))
    return found.select(
        "event_id",
        numbers.lenient_int(value).alias("value_lenient"),
        numbers.strict_int(value).alias("value_strict"),
        numbers.lenient_int(signed).alias("signed_lenient"),
        numbers.strict_int(F.get_json_object("props", "$.k")).alias("k_strict"),
        numbers.lenient_int(F.col("event_type")).alias("type_lenient"),
    )


def repo_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of every repository and of every part name, spaces included."""
    names = sample.parts(spark, sf_dir).select(
        sample.repo_of(F.col("p_partkey")).alias("name")
    ).unionAll(sample.parts(spark, sf_dir).select(F.concat("p_name", F.lit(" *~é/"), "p_brand")))
    return names.distinct().select(
        "name",
        text.percent_encoded(F.col("name")).alias("stream_key"),
        text.trimmed_repo_key(F.concat(F.lit(" "), "name", F.lit(" "))).alias("batch_key"),
        text.owner_and_name(F.col("name"))["owner"].alias("owner"),
        text.owner_and_name(F.col("name"))["name"].alias("short_name"),
    )


def time_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time expression on every event; odd seconds carry a fraction."""
    found = sample.events(spark, sf_dir)
    whole = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    exact = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    sent = F.when(F.col("event_type") == "error", exact).otherwise(whole)
    stream_time = times.stream_time(sent)
    archive_time = times.archive_time(sent)
    compact = times.compact_key(stream_time)
    return found.select(
        "event_id",
        F.date_format(stream_time, "yyyy-MM-dd HH:mm:ss").alias("stream_time"),
        F.date_format(archive_time, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("archive_time"),
        times.day_text(archive_time).alias("day"),
        times.week_key(times.bound_text(F.date_trunc("hour", archive_time))).alias("week"),
        compact.alias("compact"),
        times.clock_label(compact).alias("clock"),
        times.chart_label(archive_time).alias("label"),
    )


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return sample.events(spark, sf_dir).select(day).distinct()


def archive_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    coverage = archive_files.archive_coverage(
        sample.archive_paths(spark, sf_dir), _event_days(spark, sf_dir)
    )
    return coverage.select(
        "day",
        "whole_day",
        "complete",
        F.size("missing_hours").cast("bigint").alias("missing"),
    )


def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    coverage = archive_files.archive_coverage(
        sample.archive_paths(spark, sf_dir), _event_days(spark, sf_dir)
    )
    return archive_files.missing_hours(coverage)


def expired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_files.expired_files(sample.archive_paths(spark, sf_dir), "2024-02-15")


ALL = [
    relevant_events,
    canonical_events,
    fork_canonicalisation,
    raw_file_events,
    dedup_events,
    validity_filter,
    message_values,
    windowed_activity,
    live_metrics_rows,
    live_metrics_scan,
    repos_dimension,
    repos_insert_if_absent,
    stream_windowed_activity,
    stream_dedup_windowed,
    stream_repos,
    stream_repos_log,
    stream_late_rows,
    stream_recovered,
    stream_live_feed,
    stream_live_feed_restart,
    stream_canonical_events,
    daily_metrics,
    daily_velocity,
    incremental_velocity,
    last_day_snapshot,
    unprocessed_days,
    top_velocity,
    distinct_repos_by_language,
    distinct_repos_range,
    language_lookup,
    precedence_enrichment,
    weekly_metrics,
    language_backfill,
    daily_job,
    snapshot_job,
    processed_days_job,
    backfill_job,
    daily_job_doubled_metadata,
    daily_job_stray_days,
    stray_events_job,
    daily_job_mixed_files,
    late_day_job,
    archive_read,
    archive_quarantine,
    archive_damage,
    weekly_scan,
    prefix_scan,
    trending_now,
    new_entrants,
    trending_flags,
    dashboard_trending_now,
    dashboard_rising_languages,
    dashboard_historical_trends,
    dashboard_trending_daily,
    rising_languages,
    language_days,
    language_totals,
    activity_feed,
    historical_trends_long,
    historical_trends_slots,
    trending_daily,
    insight_panel,
    breakout_features,
    breakout_checks,
    breakout_scores,
    ai_insights,
    breakout_backtest,
    lenient_numbers,
    repo_keys,
    time_labels,
    archive_coverage,
    missing_hours,
    expired_files,
]


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {query.__name__: _configured(query) for query in ALL}
