"""DuckDB SQL stating what each query of `queries.py` must return.

Written against the supplied tables alone. Shared parts are common table
expressions that the statements put in front of their own SELECT.
"""

from __future__ import annotations

KIND = """CASE event_type WHEN 'click' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent'
    WHEN 'view' THEN 'PushEvent' WHEN 'purchase' THEN 'PullRequestEvent'
    WHEN 'error' THEN 'IssuesEvent' END"""

# Every event with its activity reading.
BASE = f"""base AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         {KIND} AS event_type,
         'org' || (user_id % 10) || '/repo' || user_id AS own_repo,
         CASE WHEN event_type = 'signup' AND CAST(json_extract_string(props, '$.k') AS BIGINT) < 20
              THEN 'org' || (user_id % 5 % 10) || '/repo' || (user_id % 5)
              ELSE 'org' || (user_id % 10) || '/repo' || user_id END AS repo_name,
         'user' || user_id AS actor,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
         date_trunc('second', ts) AS event_ts,
         strftime(ts, '%Y-%m-%d') AS day,
         CAST(floor(value * 10) AS BIGINT) AS stars_count,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS forks_count
  FROM events
)"""

META = """meta AS (
  SELECT 'org' || (p_partkey % 10) || '/repo' || p_partkey AS repo_name,
         CASE WHEN p_type = 'STANDARD' THEN 'Unknown' ELSE p_type END AS language,
         CAST(floor(p_retailprice) AS BIGINT) AS stars,
         CAST(p_size AS BIGINT) AS forks,
         p_type, p_brand, p_size
  FROM part
)"""

MESSAGES = """messages AS (
  SELECT b.*, coalesce(m.language, 'Unknown') AS language
  FROM base b LEFT JOIN meta m USING (repo_name)
  WHERE b.event_type IN ('WatchEvent', 'ForkEvent')
)"""


def _windows(source: str, width: str = "10 MINUTE") -> str:
    return f"""windows AS (
  SELECT strftime(time_bucket(INTERVAL {width}, event_ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(time_bucket(INTERVAL {width}, event_ts) + INTERVAL {width},
                  '%Y-%m-%d %H:%M:%S') AS window_end,
         date_trunc('week', time_bucket(INTERVAL {width}, event_ts)) AS monday,
         repo_name, event_type, language,
         max(stars_count) AS stars_count, max(forks_count) AS forks_count,
         max(stars_count) AS watchers_count, count(*) AS event_count
  FROM {source}
  GROUP BY ALL
)"""


LIVE = """live AS (
  SELECT window_start || '#' || repo_name || '#' || event_type || '#' || language AS row_key,
         repo_name AS name, event_type, language,
         stars_count AS stars, forks_count AS forks, watchers_count AS watchers,
         url_encode(repo_name) AS repo_key,
         strftime(monday, '%Y-%m-%d 00:00:00') AS week,
         event_count AS "count", window_start AS "window"
  FROM windows
)"""

DAILY = """daily AS (
  SELECT day, own_repo AS repo_name,
         count(*) FILTER (WHERE event_type = 'WatchEvent') AS star_count,
         count(*) FILTER (WHERE event_type = 'ForkEvent') AS fork_count,
         CAST(count(DISTINCT own_repo) AS BIGINT) AS repo_count,
         count(*) AS total_events
  FROM base
  WHERE event_type IN ('WatchEvent', 'ForkEvent')
  GROUP BY day, own_repo
)"""

VELOCITY = """velocities AS (
  SELECT *,
         coalesce(star_count - lag(star_count) OVER by_day, star_count) AS velocity,
         coalesce(fork_count - lag(fork_count) OVER by_day, fork_count) AS fork_velocity
  FROM daily
  WINDOW by_day AS (PARTITION BY repo_name ORDER BY day)
)"""

# Language and counts per repository: dimension, then brand of small parts, then type.
ENRICHED = """enriched AS (
  SELECT repo_name,
         CASE WHEN language <> 'Unknown' THEN language
              WHEN p_size <= 20 THEN CASE WHEN p_brand = 'Brand#1' THEN 'Unknown' ELSE p_brand END
              WHEN p_size <= 40 THEN p_type
              ELSE 'Unknown' END AS language,
         CASE WHEN language = 'Unknown' AND p_size <= 40 THEN stars ELSE 0 END AS api_stars,
         CASE WHEN language = 'Unknown' AND p_size <= 40 THEN forks ELSE 0 END AS api_forks
  FROM meta
)"""

WEEKLY = """weekly AS (
  SELECT v.day || '#' || v.repo_name AS row_key, v.repo_name AS name,
         coalesce(e.language, 'Unknown') AS language, url_encode(v.repo_name) AS repo_key,
         star_count AS stars, fork_count AS forks, velocity, fork_velocity, repo_count,
         coalesce(api_stars, 0) AS api_stars, coalesce(api_forks, 0) AS api_forks, v.day
  FROM velocities v LEFT JOIN enriched e USING (repo_name)
)"""

# Daily rows for the language panels: `Unknown` only stays if nothing else is known.
LANGUAGE_DAYS = """language_days AS (
  SELECT day, language, CAST(sum(stars) AS BIGINT) AS stars
  FROM weekly
  WHERE language <> 'Unknown' OR NOT EXISTS (SELECT 1 FROM weekly WHERE language <> 'Unknown')
  GROUP BY day, language
)"""

LANGUAGE_TOP = """language_top AS (
  SELECT CAST(row_number() OVER (ORDER BY stars DESC, language) AS INTEGER) AS rank,
         language, stars
  FROM (SELECT language, CAST(sum(stars) AS BIGINT) AS stars FROM language_days GROUP BY language)
  ORDER BY rank
  LIMIT 5
)"""

LANGUAGE_SLOTS = """language_slots AS (
  SELECT days.day, strftime(CAST(days.day AS DATE), '%d %b') AS label, t.rank, t.language,
         coalesce(d.stars, 0) AS stars
  FROM (SELECT DISTINCT day FROM language_days) days
  CROSS JOIN language_top t
  LEFT JOIN language_days d ON d.day = days.day AND d.language = t.language
)"""

WEEKLY_PARTS = (BASE, META, DAILY, VELOCITY, ENRICHED, WEEKLY)
LIVE_PARTS = (BASE, META, MESSAGES, _windows("messages"), LIVE)
# The stream's own input: messages that were not broken on the way.
INTACT = "intact AS (SELECT * FROM messages WHERE forks_count <> 13)"
STREAM_PARTS = (BASE, META, MESSAGES, INTACT, _windows("intact"), LIVE)
# Windows of a day, for the panels that rank one window.
DAY_PARTS = (BASE, META, MESSAGES, _windows("messages", "1 DAY"), LIVE)
DAY_STREAM_PARTS = (BASE, META, MESSAGES, INTACT, _windows("intact", "1 DAY"), LIVE)
# A batch's watermark is the newest time of the batches before it, less two days. Late rows
# are dropped by the watermark of the batch before.
LATE_PARTS = (
    BASE,
    META,
    MESSAGES,
    INTACT,
    """batched AS (
  SELECT *, least((day(event_ts) - 1) // 10, 2) + CASE WHEN CAST(event_id AS BIGINT) % 20 = 0 THEN 1 ELSE 0 END AS batch
  FROM intact
), marks AS (
  SELECT batch, max(max(event_ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
         - INTERVAL 2 DAY AS mark
  FROM batched GROUP BY batch
), in_time AS (
  SELECT b.* FROM batched b JOIN marks USING (batch)
  WHERE mark IS NULL OR time_bucket(INTERVAL 10 MINUTE, event_ts) + INTERVAL 10 MINUTE > mark
)""",
    _windows("in_time"),
    LIVE,
)

MESSAGE_COLUMNS = """event_id, event_type, repo_name, actor, language, stars_count, forks_count,
  stars_count AS watchers_count, created_at"""
WINDOW_COLUMNS = """window_start, window_end, repo_name, event_type, language, stars_count,
  forks_count, watchers_count, event_count"""


def _with(parts: tuple[str, ...], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _trending(window: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY stars DESC, newest DESC) AS INTEGER) AS rank,
       repo, language, stars
  FROM (SELECT name AS repo, arg_max(language, row_key) AS language, max(stars) AS stars,
               max(row_key) AS newest
        FROM live WHERE "window" = ({window}) GROUP BY name)
  ORDER BY rank LIMIT 8"""


NEWEST_WINDOW = 'SELECT max("window") FROM live'
SECOND_WINDOW = f'SELECT max("window") FROM live WHERE "window" < ({NEWEST_WINDOW})'


def _daily_top(candidates: str) -> str:
    return f"""SELECT rank, repo, language, score, stars, forks,
       greatest(score / greatest(max(score) OVER (), 1) * 100, 2.0) AS score_pct
FROM (
  SELECT CAST(row_number() OVER (ORDER BY velocity + fork_velocity DESC, row_key DESC) AS INTEGER)
           AS rank,
         name AS repo, language, velocity + fork_velocity AS score, stars, forks
  FROM ({candidates})
  ORDER BY rank LIMIT 10
)"""


FIRST_SEEN = """SELECT url_encode(name) AS repo_key, name AS full_name,
       first(language ORDER BY "window", event_type, language) AS language
FROM live{where} GROUP BY name"""

CANONICAL = """SELECT event_id, event_type, repo_name, actor, created_at,
       coalesce(language, 'Unknown') AS language, coalesce(stars, 0) AS stars_count,
       coalesce(forks, 0) AS forks_count, coalesce(stars, 0) AS watchers_count
FROM base LEFT JOIN meta USING (repo_name)
WHERE event_type IN ('WatchEvent', 'ForkEvent')"""

BACKFILLED = _with(
    (BASE, META, DAILY, VELOCITY),
    """SELECT day || '#' || repo_name AS row_key, repo_name AS name, day,
       CASE WHEN language <> 'Unknown' THEN language WHEN p_size <= 40 THEN p_type
            ELSE 'Unknown' END AS language,
       url_encode(repo_name) AS repo_key, star_count AS stars, fork_count AS forks,
       velocity, fork_velocity, repo_count, CAST(0 AS BIGINT) AS api_stars,
       CAST(0 AS BIGINT) AS api_forks
FROM velocities LEFT JOIN meta USING (repo_name)""",
)

RISING_LANGUAGES = """, compared AS (
  SELECT c.language, c.stars AS this_week, coalesce(p.stars, 0) AS last_week
  FROM (SELECT * FROM language_days WHERE day = (SELECT max(day) FROM language_days)) c
  LEFT JOIN (SELECT * FROM language_days WHERE day = (
               SELECT max(day) FROM language_days
               WHERE day < (SELECT max(day) FROM language_days))) p USING (language)
), top AS (
  SELECT CAST(row_number() OVER (ORDER BY this_week DESC, language) AS INTEGER) AS rank, *
  FROM compared ORDER BY rank LIMIT 10
)
SELECT rank, language, this_week, last_week,
       greatest(this_week / greatest((SELECT max(greatest(this_week, last_week)) FROM top), 1)
                * 100, 1.5) AS this_pct,
       greatest(last_week / greatest((SELECT max(greatest(this_week, last_week)) FROM top), 1)
                * 100, 1.5) AS last_pct
FROM top"""

HISTORICAL_SLOTS = (
    "SELECT day, label,\n"
    + ",\n".join(
        f"  max(language) FILTER (WHERE rank = {i}) AS lang_{i},\n"
        f"  coalesce(max(stars) FILTER (WHERE rank = {i}), 0) AS stars_{i}"
        for i in range(1, 6)
    )
    + "\nFROM language_slots GROUP BY day, label"
)
LANGUAGE_PARTS = (*WEEKLY_PARTS, LANGUAGE_DAYS, LANGUAGE_TOP, LANGUAGE_SLOTS)
NEWEST_DAY = "SELECT * FROM weekly WHERE day = (SELECT max(day) FROM weekly)"
FLAGGED = f"""SELECT *, repo NOT IN (SELECT repo FROM ({_trending(SECOND_WINDOW)})) AS is_new
FROM ({_trending(NEWEST_WINDOW)})"""
LIVE_FEED = """SELECT strftime(event_ts, '%Y%m%d%H%M%S') || '#' || event_id || '#' || repo_name || '#'
         || event_type AS row_key,
       repo_name AS repo, event_type AS type, language, url_encode(repo_name) AS repo_key
FROM intact"""

SNAPSHOT = _with(
    WEEKLY_PARTS,
    """SELECT name, arg_max(stars, day) AS last_stars, arg_max(forks, day) AS last_forks,
       arg_max(api_stars, day) AS last_api_stars, arg_max(api_forks, day) AS last_api_forks,
       max(day) AS last_day
FROM weekly GROUP BY name""",
)

HOURS = """hours AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events
  WHERE event_type = 'signup'
)"""

SQL: dict[str, str] = {
    "relevant_events": _with(
        (BASE,),
        """SELECT event_type, own_repo AS repo_name, created_at, day FROM base
WHERE event_type IN ('WatchEvent', 'ForkEvent')""",
    ),
    "canonical_events": _with((BASE, META), CANONICAL),
    "fork_canonicalisation": _with((BASE,), "SELECT event_id, own_repo, repo_name FROM base"),
    "raw_file_events": _with(
        (BASE,),
        """SELECT event_id, event_type, repo_name, actor, created_at FROM base
WHERE event_type IN ('WatchEvent', 'ForkEvent')""",
    ),
    "dedup_events": _with(
        (BASE,),
        """SELECT DISTINCT event_id, event_type, repo_name, actor, created_at FROM
(SELECT * FROM base UNION ALL SELECT * FROM base)
WHERE event_type IN ('WatchEvent', 'ForkEvent')""",
    ),
    "validity_filter": _with(
        (BASE, META, MESSAGES),
        f"SELECT {MESSAGE_COLUMNS} FROM messages WHERE forks_count <> 13",
    ),
    "message_values": _with((BASE, META, MESSAGES), f"SELECT {MESSAGE_COLUMNS} FROM messages"),
    "windowed_activity": _with(LIVE_PARTS, f"SELECT {WINDOW_COLUMNS} FROM windows"),
    "live_metrics_rows": _with(LIVE_PARTS, "SELECT * FROM live"),
    "live_metrics_scan": _with(LIVE_PARTS, "SELECT * FROM live ORDER BY row_key DESC LIMIT 20"),
    "repos_dimension": _with(LIVE_PARTS, FIRST_SEEN.format(where="")),
    "repos_insert_if_absent": _with(
        LIVE_PARTS,
        """SELECT url_encode(name) AS repo_key, name AS full_name,
       first(language ORDER BY event_type DESC, "window", language) AS language
FROM live GROUP BY name""",
    ),
    "stream_windowed_activity": _with(STREAM_PARTS, "SELECT * FROM live"),
    "stream_dedup_windowed": _with(STREAM_PARTS, "SELECT * FROM live"),
    "stream_repos": _with(STREAM_PARTS, FIRST_SEEN.format(where="")),
    "stream_repos_log": _with(
        STREAM_PARTS,
        "SELECT DISTINCT name AS full_name, CAST(1 AS BIGINT) AS logged FROM live",
    ),
    "stream_late_rows": _with(LATE_PARTS, "SELECT * FROM live"),
    "stream_recovered": _with(STREAM_PARTS, "SELECT * FROM live"),
    "stream_live_feed": _with(STREAM_PARTS, LIVE_FEED),
    "stream_live_feed_restart": _with(STREAM_PARTS, LIVE_FEED),
    "stream_canonical_events": _with((BASE, META), CANONICAL),
    "daily_metrics": _with((BASE, DAILY), "SELECT * FROM daily"),
    "daily_velocity": _with((BASE, DAILY, VELOCITY), "SELECT * FROM velocities"),
    "incremental_velocity": _with(
        (BASE, DAILY, VELOCITY),
        "SELECT * FROM velocities WHERE day = (SELECT max(day) FROM daily)",
    ),
    "last_day_snapshot": SNAPSHOT,
    "unprocessed_days": _with(
        (BASE, DAILY),
        """SELECT * FROM daily WHERE day NOT IN (
  SELECT strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'error' AND hour(ts) = 0)""",
    ),
    "top_velocity": _with(
        WEEKLY_PARTS,
        """SELECT name, day, stars, velocity FROM weekly
ORDER BY velocity DESC, name, day LIMIT 10""",
    ),
    "distinct_repos_by_language": _with(
        WEEKLY_PARTS,
        "SELECT day, language, count(DISTINCT name) AS repos FROM weekly GROUP BY day, language",
    ),
    "distinct_repos_range": _with(
        WEEKLY_PARTS,
        """SELECT language, count(DISTINCT name) AS repos, true AS is_close FROM weekly
WHERE day > (SELECT min(day) FROM weekly) GROUP BY language""",
    ),
    "language_lookup": _with(
        (META,), "SELECT repo_name, language FROM meta WHERE language <> 'Unknown'"
    ),
    "precedence_enrichment": _with((META, ENRICHED), "SELECT * FROM enriched"),
    "weekly_metrics": _with(WEEKLY_PARTS, "SELECT * FROM weekly"),
    "language_backfill": BACKFILLED,
    "daily_job": _with(WEEKLY_PARTS, "SELECT * FROM weekly"),
    "backfill_job": BACKFILLED,
    "daily_job_doubled_metadata": _with(WEEKLY_PARTS, "SELECT * FROM weekly"),
    "daily_job_stray_days": _with(
        WEEKLY_PARTS,
        "SELECT * FROM weekly WHERE day < (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events)",
    ),
    "stray_events_job": _with(WEEKLY_PARTS, "SELECT * FROM weekly"),
    "daily_job_mixed_files": "WITH "
    + BASE
    + """, kept AS (
  SELECT * FROM base WHERE forks_count <> 13
     AND day = (SELECT min(strftime(ts, '%Y-%m-%d')) FROM events)),
"""
    + DAILY.replace("FROM base", "FROM kept")
    + " SELECT repo_name AS name, day, star_count AS stars, fork_count AS forks,"
    + " star_count AS velocity FROM daily",
    "late_day_job": _with(WEEKLY_PARTS, "SELECT * FROM weekly"),
    "snapshot_job": SNAPSHOT,
    "processed_days_job": """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE event_type IN ('click', 'signup')""",
    "archive_read": "WITH "
    + BASE
    + """, kept AS (SELECT * FROM base WHERE forks_count <> 13),
"""
    + DAILY.replace("FROM base", "FROM kept")
    + " SELECT * FROM daily",
    "archive_quarantine": """SELECT CAST(NULL AS VARCHAR) AS type, '{bad ' || event_id AS record
FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) = 13""",
    "archive_damage": """SELECT '2024-01-' || ['01', '11', '21'][part + 1] AS day, part <> 1 AS is_whole,
       CASE WHEN part <> 1 THEN lines END AS lines
FROM (SELECT least((day(ts) - 1) // 10, 2) AS part, count(*) AS lines FROM events GROUP BY part)""",
    "weekly_scan": _with(WEEKLY_PARTS, "SELECT * FROM weekly ORDER BY row_key DESC LIMIT 200"),
    "prefix_scan": _with(
        WEEKLY_PARTS,
        """SELECT * FROM weekly WHERE starts_with(row_key, '2024-01-1')
ORDER BY row_key DESC LIMIT 100""",
    ),
    "insight_panel": """SELECT 'org' || (p_partkey % 10) || '/repo' || p_partkey AS repo,
       p_size / 50 AS probability, CAST(trunc(p_size / 50 * 100) AS INTEGER) AS probability_pct,
       p_type AS cluster, CAST(trunc(p_retailprice - 1000) AS BIGINT) AS predicted_stars
FROM part ORDER BY probability DESC, repo LIMIT 5""",
    "trending_now": _with(DAY_PARTS, _trending(NEWEST_WINDOW)),
    "trending_flags": _with(DAY_PARTS, FLAGGED),
    "dashboard_trending_now": _with(DAY_STREAM_PARTS, FLAGGED),
    "new_entrants": _with(
        DAY_PARTS,
        f"""SELECT * FROM ({_trending(NEWEST_WINDOW)})
WHERE repo NOT IN (SELECT repo FROM ({_trending(SECOND_WINDOW)}))""",
    ),
    "rising_languages": _with((*WEEKLY_PARTS, LANGUAGE_DAYS), RISING_LANGUAGES),
    "dashboard_rising_languages": _with((*WEEKLY_PARTS, LANGUAGE_DAYS), RISING_LANGUAGES),
    "language_days": _with((*WEEKLY_PARTS, LANGUAGE_DAYS), "SELECT * FROM language_days"),
    "language_totals": _with(
        (*WEEKLY_PARTS, LANGUAGE_DAYS, LANGUAGE_TOP), "SELECT * FROM language_top"
    ),
    "activity_feed": _with(
        (BASE, META, MESSAGES),
        """SELECT strftime(event_ts, '%Y%m%d%H%M%S') || '#' || event_id || '#' || repo_name || '#'
         || event_type AS row_key,
       strftime(event_ts + INTERVAL 1 HOUR, '%H:%M:%S') AS "timestamp",
       event_type AS type, repo_name AS repo
FROM messages ORDER BY row_key DESC LIMIT 20""",
    ),
    "historical_trends_long": _with(
        (*WEEKLY_PARTS, LANGUAGE_DAYS, LANGUAGE_TOP, LANGUAGE_SLOTS),
        "SELECT * FROM language_slots",
    ),
    "historical_trends_slots": _with(LANGUAGE_PARTS, HISTORICAL_SLOTS),
    "dashboard_historical_trends": _with(LANGUAGE_PARTS, HISTORICAL_SLOTS),
    "trending_daily": _with(WEEKLY_PARTS, _daily_top(NEWEST_DAY)),
    "dashboard_trending_daily": _with(WEEKLY_PARTS, _daily_top(NEWEST_DAY)),
    "breakout_features": _with(
        WEEKLY_PARTS,
        """SELECT name, day, stars, forks, velocity, fork_velocity,
       CAST(row_number() OVER by_day AS INTEGER) AS active_days,
       lead(velocity) OVER by_day AS next_velocity
FROM weekly WINDOW by_day AS (PARTITION BY name ORDER BY day)""",
    ),
    "breakout_backtest": _with(
        WEEKLY_PARTS,
        """SELECT day, count(*) AS repos, count(*) FILTER (next > 0) AS grew, true AS hits_fit, true AS errors_fit
FROM (SELECT day, lead(velocity) OVER (PARTITION BY name ORDER BY day) AS next FROM weekly)
WHERE next IS NOT NULL AND day IN (
  SELECT DISTINCT day FROM weekly WHERE day < (SELECT max(day) FROM weekly) ORDER BY day DESC LIMIT 3)
GROUP BY day""",
    ),
    "breakout_checks": _with(
        WEEKLY_PARTS,
        """SELECT DISTINCT name, true AS is_probability, true AS is_cluster, true AS is_growth
FROM weekly""",
    ),
    "lenient_numbers": """SELECT event_id,
       CAST(trunc(value) AS BIGINT) AS value_lenient,
       CAST(0 AS BIGINT) AS value_strict,
       -CAST(trunc(round(value, 2)) AS BIGINT) AS signed_lenient,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_strict,
       CAST(0 AS BIGINT) AS type_lenient
FROM events""",
    "repo_keys": """SELECT DISTINCT name, url_encode(name) AS stream_key,
       url_encode(trim(name)) AS batch_key,
       split_part(name, '/', 1) AS owner, split_part(name, '/', 2) AS short_name
FROM (SELECT 'org' || (p_partkey % 10) || '/repo' || p_partkey AS name FROM part
      UNION ALL SELECT p_name || ' *~é/' || p_brand FROM part)""",
    "time_labels": """SELECT event_id,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stream_time,
       strftime(CASE WHEN event_type = 'error' THEN ts ELSE date_trunc('second', ts) END,
                '%Y-%m-%d %H:%M:%S.%f') AS archive_time,
       strftime(ts, '%Y-%m-%d') AS day,
       strftime(date_trunc('week', ts), '%Y-%m-%d 00:00:00') AS week,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y%m%d%H%M%S') ELSE 'none' END AS compact,
       CASE WHEN event_type <> 'error' THEN strftime(ts + INTERVAL 1 HOUR, '%H:%M:%S')
            ELSE 'none' END AS clock,
       strftime(ts, '%d %b') AS label
FROM events""",
    "archive_coverage": _with(
        (HOURS,),
        """SELECT day, false AS whole_day, count(hour) = 24 AS complete, 24 - count(hour) AS missing
FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events) LEFT JOIN hours USING (day)
GROUP BY day""",
    ),
    "missing_hours": _with(
        (HOURS,),
        """SELECT day, hour FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events) d,
     (SELECT CAST(range AS INTEGER) AS hour FROM range(24)) h
WHERE NOT EXISTS (SELECT 1 FROM hours x WHERE x.day = d.day AND x.hour = h.hour)""",
    ),
    "expired_files": _with(
        (HOURS,),
        """SELECT '/archive/' || day || '-' || hour || '.json.gz' AS path, day FROM hours
WHERE day < strftime(DATE '2024-02-15' - INTERVAL 30 DAY, '%Y-%m-%d')""",
    ),
}
