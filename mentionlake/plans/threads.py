"""Queries of capture reports, comment trees and polling state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.operators import capture, ingest_rates, polling, threads
from mentionlake.plans.bindings import ctes, frame
from mentionlake.plans.registry import query
from mentionlake.session import new_folder

HOURS = """
polls AS (
  SELECT date_trunc('hour', polled_at) AS hour, thread_id, comments_in_db_for_thread AS in_db,
    num_comments_reported AS reported, was_truncated,
    row_number() OVER (PARTITION BY date_trunc('hour', polled_at), thread_id
      ORDER BY polled_at DESC, event_id DESC) AS rn FROM b_capture),
volume AS (
  SELECT date_trunc('hour', created_utc) AS hour, count(*) AS n FROM b_event_comments
  WHERE (CAST(created_utc AS DATE), post_id) IN (SELECT (CAST(hour AS DATE), thread_id) FROM polls)
  GROUP BY 1),
snapshots AS (SELECT hour, sum(in_db) AS in_db, sum(reported) AS reported FROM polls
  WHERE rn = 1 GROUP BY hour),
truncations AS (SELECT hour, count(*) AS n FROM polls WHERE was_truncated GROUP BY hour),
hours AS (
  SELECT hour, CAST(coalesce(volume.n, 0) AS BIGINT) AS comment_volume,
    CAST(coalesce(in_db, 0) AS BIGINT) AS comments_in_db,
    CAST(coalesce(reported, 0) AS BIGINT) AS num_comments_reported,
    CASE WHEN coalesce(reported, 0) > 0 THEN in_db / reported * 100 END AS capture_rate_pct,
    CAST(coalesce(truncations.n, 0) AS BIGINT) AS truncations,
    extract(hour FROM hour) BETWEEN 13 AND 20 AS market_open
  FROM volume FULL JOIN snapshots USING (hour) FULL JOIN truncations USING (hour)),
days AS (
  SELECT CAST(hour AS DATE) AS day, CAST(sum(comment_volume) AS BIGINT) AS total_volume,
    CAST(sum(truncations) AS BIGINT) AS total_truncations,
    CAST(sum(CASE WHEN market_open THEN truncations ELSE 0 END) AS BIGINT) AS market_open_truncations,
    count(*) FILTER (market_open AND truncations > 0) AS market_open_hours_with_truncations,
    round(avg(capture_rate_pct), 6) AS avg_capture_pct, round(min(capture_rate_pct), 6) AS min_capture_pct
  FROM hours GROUP BY 1)"""
REPORT = f"WITH {ctes('b_capture', 'b_event_comments')}, {HOURS}"


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.hourly_report(
        frame(spark, sf_dir, "b_capture"), frame(spark, sf_dir, "b_event_comments")
    )


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = capture.day_summary(hours(spark, sf_dir))
    rates = ("avg_capture_pct", "min_capture_pct")
    return summary.withColumns({c: F.round(c, 6) for c in rates})


query("capture_hourly", f"{REPORT} SELECT * FROM hours")(hours)
DAY = "2024-01-05"


@query("capture_day", f"{REPORT} SELECT * FROM hours WHERE CAST(hour AS DATE) = DATE '{DAY}'")
def capture_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of one UTC day."""
    return capture.hourly_report(frame(spark, sf_dir, "b_capture"), frame(spark, sf_dir, "b_event_comments"), DAY)


query("capture_day_summary", f"{REPORT} SELECT * FROM days")(days)


@query(
    "capture_verdict",
    f"""{REPORT} SELECT day, CASE WHEN total_truncations = 0
    THEN 'Verdict: zero truncations — poller is capturing everything fetchable.'
  WHEN market_open_truncations = 0 THEN
    'Verdict: no truncations during market hours (UTC 13:00–20:59) — healthy; off-hours truncations only ('
    || total_truncations || ' total).'
  WHEN market_open_hours_with_truncations >= 2 OR market_open_truncations >= 3 THEN
    'Verdict: repeated truncations during market hours — need /api/morechildren paginator.'
  ELSE 'Verdict: isolated truncation(s) during market hours — watch the next open; capture % alone is not actionable.'
  END AS verdict FROM days""",
)
def capture_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days(spark, sf_dir).select("day", capture.verdict().alias("verdict"))


@query(
    "thread_comment_counts",
    f"""WITH {ctes('b_comments')}
SELECT post_id, count(*) AS n_comments FROM b_comments GROUP BY post_id""",
)
def thread_comment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.comments_per_thread(frame(spark, sf_dir, "b_comments"))


@query(
    "record_stats",
    f"""WITH {ctes('b_capture', 'b_event_comments')},
held AS (SELECT post_id, count(*) AS n FROM b_event_comments GROUP BY post_id)
SELECT event_id, c.thread_id, polled_at, num_comments_reported,
  CAST(coalesce(n, 0) AS INT) AS comments_in_db_for_thread, fetched_this_cycle, was_truncated
FROM b_capture AS c LEFT JOIN held ON post_id = c.thread_id""",
)
def record_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every poll with its thread's comment count, appended to the statistics table."""
    table = new_folder(spark, "stats")
    polls = frame(spark, sf_dir, "b_capture").drop("comments_in_db_for_thread")
    stats = capture.poll_stats(polls, frame(spark, sf_dir, "b_event_comments"))
    for _ in range(2):  # a repeated run adds nothing
        capture.append_stats(stats, table, "first")
    return spark.read.parquet(table).drop("polled_date", "run")


TREE = f"""WITH {ctes('b_tree', 'b_cursors')},
tops AS (
  SELECT t.*, cursor_utc FROM b_tree AS t JOIN b_cursors USING (post_id) WHERE parent_id = post_id
    AND (cursor_utc IS NULL OR created_utc >= cursor_utc - INTERVAL 12 HOUR)),
firsts AS (SELECT r.*, cursor_utc FROM b_tree AS r JOIN tops ON r.parent_id = tops.id),
seconds AS (SELECT r.*, cursor_utc FROM b_tree AS r JOIN firsts ON r.parent_id = firsts.id),
found AS (SELECT *, 0 AS depth FROM tops UNION ALL SELECT *, 1 FROM firsts UNION ALL SELECT *, 2 FROM seconds)
SELECT id, post_id, created_utc, depth FROM found WHERE cursor_utc IS NULL OR created_utc >= cursor_utc"""


@query("tree_since_cursor", TREE)
def tree_since_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment, with a reply eleven hours later to each."""
    return threads.collect_since(frame(spark, sf_dir, "b_tree"), frame(spark, sf_dir, "b_cursors"))


FETCH = 256


@query(
    "bounded_fetch",
    f"""WITH {ctes('b_event_comments')}
SELECT event_id, id, post_id, created_utc, fetch_rank, n >= {FETCH} AS truncated FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY created_utc DESC, event_id DESC) AS fetch_rank,
    count(*) OVER (PARTITION BY post_id) AS n FROM b_event_comments)
WHERE fetch_rank <= {FETCH}""",
)
def bounded_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.bounded_fetch(frame(spark, sf_dir, "b_event_comments"), FETCH, tie="event_id")


@query(
    "daily_thread_pick",
    f"""WITH {ctes('b_hot_posts')}
SELECT subreddit, id, title, hot_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY place) AS rn FROM (
    SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY hot_rank, id) AS place FROM b_hot_posts)
  WHERE place <= 15 AND stickied
    AND regexp_matches(coalesce(title, ''), '(daily discussion|what are your moves|moves for)', 'i'))
WHERE rn = 1""",
)
def daily_thread_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.daily_thread(frame(spark, sf_dir, "b_hot_posts"))


NOW = "2024-01-02 00:00:00"


@query(
    "posts_due",
    f"""WITH {ctes('b_hot_posts', 'b_posts')},
posts AS (SELECT id, title, created_utc,
    CASE WHEN subreddit = 'en' THEN 'wallstreetbets' ELSE subreddit END AS subreddit
  FROM b_posts JOIN (SELECT id, title FROM b_hot_posts) AS h USING (id) ),
passes AS (SELECT '1h' AS pass, 55 AS low, 70 AS high UNION ALL SELECT '24h', 1410, 1470),
done AS (SELECT id AS post_id, '1h' AS pass, CASE WHEN score % 2 = 0 THEN 'done' ELSE 'pending' END AS value
  FROM b_posts)
SELECT id, pass, subreddit, created_utc, id = 't3_0' OR (subreddit = 'wallstreetbets' AND
    regexp_matches(coalesce(title, ''), '(daily discussion|what are your moves|moves for)', 'i')) AS skip
FROM posts, passes
WHERE created_utc BETWEEN TIMESTAMP '{NOW}' - to_minutes(high) AND TIMESTAMP '{NOW}' - to_minutes(low)
  AND NOT EXISTS (SELECT 1 FROM done WHERE post_id = id AND done.pass = passes.pass AND value = 'done')"""
    .replace("SELECT id, title, created_utc,", "SELECT b_posts.id, h.title, created_utc,")
    .replace(" USING (id) )", " ON b_posts.id = h.id)"),
)
def posts_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = frame(spark, sf_dir, "b_posts").drop("title")
    titles = frame(spark, sf_dir, "b_hot_posts").select("id", "title")
    renamed = F.when(F.col("subreddit") == "en", "wallstreetbets").otherwise(F.col("subreddit"))
    value = F.when(F.col("score") % 2 == 0, "done").otherwise("pending")
    done = posts.select(F.col("id").alias("post_id"), F.lit("1h").alias("pass"), value.alias("value"))
    return threads.posts_due(
        posts.join(titles, "id").withColumn("subreddit", renamed),
        done,
        F.to_timestamp(F.lit(NOW)),
        current_thread=F.lit("t3_0"),
    )


@query(
    "truncation_streak",
    f"""WITH {ctes('b_polls')},
islands AS (SELECT *, sum(CASE WHEN was_truncated THEN 0 ELSE 1 END)
  OVER (PARTITION BY thread_id ORDER BY polled_at, event_id) AS island FROM b_polls)
SELECT event_id, thread_id, polled_at, was_truncated, CAST(sum(CASE WHEN was_truncated THEN 1 ELSE 0 END)
  OVER (PARTITION BY thread_id, island ORDER BY polled_at, event_id) AS BIGINT) AS streak FROM islands""",
)
def truncation_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = frame(spark, sf_dir, "b_polls")
    return polling.truncation_streak(polls.select("event_id", "thread_id", "polled_at", "was_truncated"))


REPLAY = f"""WITH {ctes('b_polls')},
numbered AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY polled_at, event_id) AS pos
  FROM b_polls),
runs AS (SELECT *, max(CASE WHEN pos = 1 OR NOT was_truncated THEN pos END)
  OVER (PARTITION BY thread_id ORDER BY pos) AS clear FROM numbered),
counted AS (SELECT *, (pos - clear) % 3 AS streak, pos = 1 AS cold_start,
  pos > 1 AND max_seen_utc IS NOT NULL AND (pos - clear) % 3 = 0 AS cursor_advanced FROM runs)
SELECT thread_id, polled_at, event_id, cold_start, cursor_advanced, CAST(streak AS BIGINT) AS streak,
  last_value(CASE WHEN cold_start THEN polled_at WHEN cursor_advanced THEN max_seen_utc END IGNORE NULLS)
    OVER (PARTITION BY thread_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cursor_utc,
  CASE WHEN cursor_advanced AND was_truncated
    THEN greatest(0, coalesce(num_comments_reported, 0) - fetched_this_cycle) END AS estimated_skipped
FROM counted"""


@query("cursor_replay", REPLAY)
def cursor_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polling.cursor_replay(frame(spark, sf_dir, "b_polls"))


CUT = 24  # comments of a fetch, few enough that some polls of the test tables are cut
FIGURES = f"""
firsts AS (SELECT thread_id, polled_at, min(event_id) AS event_id FROM b_sparse_polls GROUP BY ALL),
placed AS (SELECT f.event_id, max(c.created_utc) AS max_seen_utc, count(*) AS n
  FROM b_event_comments AS c ASOF JOIN firsts AS f ON c.post_id = f.thread_id AND c.created_utc <= f.polled_at GROUP BY 1),
figures AS (SELECT event_id, thread_id, polled_at, num_comments_reported, max_seen_utc,
    CAST(least(coalesce(n, 0), {CUT}) AS INT) AS fetched_this_cycle, coalesce(n, 0) >= {CUT} AS was_truncated
  FROM b_sparse_polls LEFT JOIN placed USING (event_id))"""


@query("poll_figures", f"WITH {ctes('b_sparse_polls', 'b_event_comments')}, {FIGURES} SELECT * FROM figures")
def poll_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of fewer polls fetched, from the comments that were written before it."""
    return polling.poll_figures(frame(spark, sf_dir, "b_event_comments"), frame(spark, sf_dir, "b_sparse_polls"), CUT)


@query(
    "figures_replay",
    REPLAY.replace(f"WITH {ctes('b_polls')}", f"WITH {ctes('b_sparse_polls', 'b_event_comments')}, {FIGURES}").replace("b_polls", "figures"),
)
def figures_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors replayed from comments and poll times alone."""
    return polling.cursor_replay(poll_figures(spark, sf_dir))


# a day's thread is primary from its first second; polls go to the threads of that day and the two before
DRAINS = """
changes AS (SELECT *, lag(thread_id) OVER (PARTITION BY subreddit ORDER BY polled_at) AS previous
  FROM b_primary_log),
drains AS (SELECT subreddit, previous AS thread_id, arg_min(thread_id, polled_at) AS successor,
  min(polled_at) AS drain_started FROM changes WHERE previous <> thread_id GROUP BY 1, 2),
during AS (SELECT b.*, drain_started,
    row_number() OVER (PARTITION BY b.thread_id ORDER BY polled_at, event_id) AS pos
  FROM b_drain_polls AS b JOIN drains USING (thread_id) WHERE polled_at >= drain_started),
idle AS (SELECT *, pos - coalesce(max(CASE WHEN ingested > 0 THEN pos END)
  OVER (PARTITION BY thread_id ORDER BY pos), 0) AS idle_polls FROM during),
ends AS (SELECT thread_id, arg_min(polled_at, pos) AS retired_at, arg_min(idle_polls, pos) AS idle_polls
  FROM idle WHERE ingested = 0 AND (idle_polls >= 6 OR polled_at >= drain_started + INTERVAL 18 HOUR)
  GROUP BY thread_id)"""


@query(
    "rollover_drain",
    f"""WITH {ctes('b_primary_log', 'b_drain_polls')}, {DRAINS}
SELECT subreddit, thread_id, successor, drain_started, retired_at, idle_polls
FROM drains LEFT JOIN ends USING (thread_id)""",
)
def rollover_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    drains = polling.rollovers(frame(spark, sf_dir, "b_primary_log"))
    return polling.drain_outcomes(drains, frame(spark, sf_dir, "b_drain_polls"))


@query(
    "threads_to_poll",
    f"""WITH {ctes('b_primary_log', 'b_drain_polls')},
seen AS (SELECT DISTINCT CAST(polled_at AS DATE) AS day, thread_id FROM b_drain_polls)
SELECT strftime(day, '%Y-%m-%d') AS subreddit, s.thread_id,
  CAST(row_number() OVER (PARTITION BY day
    ORDER BY CASE WHEN s.thread_id = p.thread_id THEN 0 ELSE 1 END, s.thread_id) - 1 AS INT) AS poll_order
FROM seen AS s JOIN b_primary_log AS p ON CAST(p.polled_at AS DATE) = day""",
)
def threads_to_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day as its own forum: the primary thread, then the threads polled that day."""
    polls = frame(spark, sf_dir, "b_drain_polls")
    seen = polls.groupBy(F.to_date("polled_at").alias("day")).agg(
        F.array_sort(F.collect_set("thread_id")).alias("draining")
    )
    primary = frame(spark, sf_dir, "b_primary_log").select(
        F.to_date("polled_at").alias("day"), F.col("thread_id").alias("primary")
    )
    state = seen.join(primary, "day").withColumn("subreddit", F.date_format("day", "yyyy-MM-dd"))
    return polling.threads_to_poll(state)


def heartbeat_sql(log: str, hours: str) -> str:
    """Rates of the given hours of a log."""
    return f"""WITH {ctes(log)},
totals AS (SELECT date_trunc('hour', ts) AS hour, sum(n) FILTER (kind = 'posts') AS posts,
  sum(n) FILTER (kind = 'comments') AS comments, sum(n) FILTER (kind = 'requests') AS requests
  FROM {log} GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM totals),
beats AS (SELECT hour, CAST(coalesce(posts, 0) AS BIGINT) AS posts_per_hour,
    CAST(coalesce(comments, 0) AS BIGINT) AS comments_per_hour,
    CAST(coalesce(requests, 0) AS BIGINT) AS api_requests
  FROM spine LEFT JOIN totals USING (hour) WHERE {hours})
SELECT *, api_requests / 60 AS requests_per_minute, api_requests / 60 > 80 AS rate_alert,
  posts_per_hour = 0 AND comments_per_hour = 0 AS idle_alert FROM beats"""


@query("heartbeat_hourly", heartbeat_sql("b_ingest_log", "true"))
def heartbeat_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_rates.heartbeat(frame(spark, sf_dir, "b_ingest_log"))
