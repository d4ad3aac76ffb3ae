"""Queries of table layout and of the streams, which all read and write files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.operators import archive, bucketed, layout, snapshots
from mentionlake.plans import threads as th
from mentionlake.plans.bindings import BINDINGS, ctes, frame, spark_sql, tables_in
from mentionlake.plans.corpus import EVERY_FORUM, MAPPED_COMMENTS, comment_lines, write_zstd
from mentionlake.plans.registry import query
from mentionlake.session import new_folder
from mentionlake.streaming import cursor, heartbeat, jobs, passes, trees

TODAY = "2024-01-20"
BUCKETS = 8


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        F.col("event_type").alias("subreddit"),
        F.col("ts").cast("timestamp").alias("created_utc"),
        "value",
    )


def date_table(spark: SparkSession, sf_dir: str, *loads: tuple[int, int]) -> DataFrame:
    """Events as a date-partitioned table, written in one load per given range of hours."""
    path = new_folder(spark, "table")
    rows = event_rows(spark, sf_dir)
    for first, last in loads or [(0, 23)]:
        layout.append_rows(rows.filter(F.hour("created_utc").between(first, last)), path)
    return layout.read_table(spark, path)


@query(
    "layout_write",
    """SELECT CAST(ts AS DATE) AS created_date, event_type AS subreddit, count(*) AS n,
  min(ts) AS first_utc, max(ts) AS last_utc FROM events GROUP BY 1, 2""",
)
def layout_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_table(spark, sf_dir).groupBy("created_date", "subreddit").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("created_utc").alias("first_utc"),
        F.max("created_utc").alias("last_utc"),
    )


@query(
    "compact_partitions",
    f"""SELECT created_date, CAST(sum(n) AS BIGINT) AS rows,
  CASE WHEN created_date < DATE '{TODAY}' - INTERVAL 7 DAY THEN 1 ELSE count(*) END AS files
FROM (SELECT CAST(ts AS DATE) AS created_date, floor(extract(hour FROM ts) / 8.0) AS load, count(*) AS n
  FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of three loads a day; after compaction old dates have one file, young ones up to three."""
    table = date_table(spark, sf_dir, (0, 7), (8, 15), (16, 23))
    today, target = F.lit(TODAY).cast("date"), new_folder(spark, "compacted")
    days = layout.compact(table, today, target)
    first, *others = map(layout.files_by_date, layout.compacted_parts(table, days, target))
    files = reduce(DataFrame.unionByName, others, first)
    return files.select("created_date", "rows", "files")


@query(
    "partition_report",
    """WITH tables AS (
  SELECT 'events' AS table_name, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 2
  UNION ALL SELECT 'weekdays', CAST(ts AS DATE), count(*) FROM events
  WHERE extract(isodow FROM ts) <= 5 GROUP BY 2)
SELECT table_name, CAST(sum(n) AS BIGINT) AS rows, count(*) AS nonempty_days,
  date_diff('day', min(d), max(d)) + 1 - count(*) AS empty_days FROM tables GROUP BY table_name""",
)
def partition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy of the event table and of one that has no weekends. Sizes are left out."""
    table, path = date_table(spark, sf_dir), new_folder(spark, "table")
    layout.append_rows(table.filter("weekday(created_date) < 5"), path)
    tables = {"events": table, "weekdays": layout.read_table(spark, path)}
    return layout.occupancy(tables).drop("bytes")


AFTER_POLL = f"""WITH {ctes('b_comments')}
SELECT id, created_utc, subreddit, author, score + 3 AS score FROM b_comments
UNION ALL SELECT concat(id, '_new'), created_utc, subreddit, 'polled', score FROM b_comments"""


def polled_table(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A raw table of all comments, and a poll that saw each again and found one more beside it."""
    comments = frame(spark, sf_dir, "b_comments").select("id", "created_utc", "subreddit", "author", "score")
    table = new_folder(spark, "table")
    layout.append_rows(comments.withColumn("ingested_at", F.current_timestamp()), table)
    seen = comments.withColumns({"score": F.col("score") + 3, "author": F.lit("polled")})
    found = comments.withColumns({"id": F.concat("id", F.lit("_new")), "author": F.lit("polled")})
    return table, seen.unionByName(found).withColumn("poll", F.lit(1))


@query("poll_upsert", AFTER_POLL)
def poll_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, polled = polled_table(spark, sf_dir)
    archive.upsert_rows(polled, table, ["score"], ["poll"])
    return spark.read.parquet(table).drop("ingested_at", layout.PARTITION)


@query("bucketed_upsert", AFTER_POLL)
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a table whose rows lie in buckets by key."""
    unbucketed, polled = polled_table(spark, sf_dir)
    table = new_folder(spark, "bucketed")
    bucketed.append_rows(layout.read_table(spark, unbucketed), table, BUCKETS)
    archive.upsert_rows(polled, table, ["score"], ["poll"], BUCKETS)
    return bucketed.read(spark, table, BUCKETS).drop("ingested_at", layout.PARTITION)


# ---- streams --------------------------------------------------------------------------------


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A binding over the files of its table as they arrive."""
    inputs = {}
    for table in tables_in(BINDINGS[name]):
        path = f"{sf_dir}/{table}.parquet"
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        if snapshots.is_folder(spark, path):
            df = reader.parquet(path)
        else:
            df = reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
        for field, kind in df.dtypes:
            if kind == "timestamp_ntz":
                df = df.withColumn(field, df[field].cast("timestamp"))
        inputs[table] = df
    return spark.sql(spark_sql(BINDINGS[name]), **inputs)


def finished(streamed: DataFrame, label: str) -> DataFrame:
    return jobs.read_output(streamed, jobs.run_available(streamed, label))


@query(
    "heartbeat_stream",
    th.heartbeat_sql("b_quiet_log", "hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM b_quiet_log)"),
)
def heartbeat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that is silent from two to seven every night."""
    return finished(heartbeat.heartbeat(stream(spark, sf_dir, "b_quiet_log")), "heartbeat")


@query("stream_ingest_dedup", MAPPED_COMMENTS)
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment dumps that arrive twice; the second arrival, with other scores, adds nothing."""
    base = new_folder(spark, "incremental")
    comments = frame(spark, sf_dir, "b_comments")
    for shift in (0, 100):
        lines = comment_lines(comments, score_shift=shift).select("value")
        lines.write.mode("append").text(f"{base}/dumps")
        jobs.ingest_lines(
            spark, f"{base}/dumps", f"{base}/table", f"{base}/checkpoint",
            kind="comments", wanted=EVERY_FORUM,
        )
    return spark.read.parquet(f"{base}/table").drop("raw", "ingested_at", layout.PARTITION)


@query("stream_ingest_recent", MAPPED_COMMENTS)
def stream_ingest_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dumps arrive in three parts by id, each part with rows of the one before it. Keys of two days are
    remembered, so of each part some rows are told by the state and most by the table."""
    base = new_folder(spark, "incremental")
    comments = frame(spark, sf_dir, "b_comments").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(3)))
    for part in range(3):
        for score_shift, rows in ((0, comments.filter(F.col("part") == part)), (100, comments.filter(F.col("part") == part - 1))):
            lines = comment_lines(rows.drop("part"), score_shift=score_shift).select("value")
            lines.write.mode("append").text(f"{base}/dumps")
        jobs.ingest_lines(
            spark, f"{base}/dumps", f"{base}/table", f"{base}/checkpoint",
            kind="comments", wanted=EVERY_FORUM, recent_hours=48,
        )
    return spark.read.parquet(f"{base}/table").drop("raw", "ingested_at", layout.PARTITION)


@query("stream_ingest_zstd", MAPPED_COMMENTS)
def stream_ingest_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps with long windows that arrive twice, the second time with other scores."""
    base = new_folder(spark, "incremental")
    comments = frame(spark, sf_dir, "b_comments")
    for arrival, shift in enumerate((0, 100)):
        write_zstd(comment_lines(comments, score_shift=shift), f"{base}/dumps/{arrival}")
        jobs.ingest_lines(
            spark, f"{base}/dumps", f"{base}/table", f"{base}/checkpoint",
            kind="comments", wanted=EVERY_FORUM, packed=True,
        )
    return spark.read.parquet(f"{base}/table").drop("raw", "ingested_at", layout.PARTITION)


@query("poll_upsert_stream", AFTER_POLL)
def poll_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polled rows as a stream, and all of its batches once more."""
    table, polled = polled_table(spark, sf_dir)
    folder = new_folder(spark, "polled")
    polled.write.parquet(folder)
    for _ in range(2):
        arriving = spark.readStream.schema(polled.schema).parquet(folder)
        jobs.upsert_polled(arriving, table, new_folder(spark, "checkpoint"), mutable=["score"], order=["poll"])
    return spark.read.parquet(table).drop("ingested_at", layout.PARTITION)


@query("cursor_stream", th.REPLAY)
def cursor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(cursor.cursors(stream(spark, sf_dir, "b_polls")), "cursors")


@query(
    "drain_stream",
    f"""WITH {ctes('b_primary_log', 'b_drain_polls')}, {th.DRAINS}
SELECT subreddit, thread_id, drain_started, retired_at, idle_polls
FROM drains JOIN ends USING (thread_id)""",
)
def drain_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "drain-log")
    primary = frame(spark, sf_dir, "b_primary_log").withColumns(
        {"event_id": F.lit(-1).cast("bigint"), "is_primary": F.lit(True), "ingested": F.lit(0)}
    )
    polls = frame(spark, sf_dir, "b_drain_polls").withColumns(
        {"subreddit": F.lit("daily"), "is_primary": F.lit(False)}
    )
    log = primary.unionByName(polls)
    log.write.parquet(folder)
    arriving = spark.readStream.schema(log.schema).parquet(folder)
    return finished(cursor.retirements(arriving), "retired")


def arriving_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tree")
    tree = frame(spark, sf_dir, "b_tree")
    tree.write.parquet(folder)
    return spark.readStream.schema(tree.schema).parquet(folder)


IN_GRACE = "r.created_utc BETWEEN top_created AND top_created + INTERVAL 12 HOUR"


@query(
    "late_reply_stream",
    f"""WITH {ctes('b_tree')},
tops AS (SELECT id, created_utc AS top_created FROM b_tree WHERE parent_id = post_id),
firsts AS (SELECT r.*, top_created FROM b_tree AS r JOIN tops AS t ON r.parent_id = t.id WHERE {IN_GRACE}),
seconds AS (SELECT r.*, top_created FROM b_tree AS r JOIN firsts AS t ON r.parent_id = t.id WHERE {IN_GRACE})
SELECT id, post_id, created_utc, top_created, 1 AS depth FROM firsts
UNION ALL SELECT id, post_id, created_utc, top_created, 2 FROM seconds""",
)
def late_reply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(trees.tree_stream(arriving_tree(spark, sf_dir)).filter("depth > 0"), "late-replies")


@query("tree_stream", th.TREE)
def tree_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fetch since each thread's cursor finds, as the comments arrive."""
    cursors = frame(spark, sf_dir, "b_cursors")
    return finished(trees.collect_since(arriving_tree(spark, sf_dir), cursors), "tree")


@query(
    "due_pass_stream",
    f"""WITH {ctes('b_due_posts')},
passes AS (SELECT '1h' AS pass, 55 AS low, 70 AS high UNION ALL SELECT '24h', 1410, 1470),
awaited AS (SELECT * FROM b_due_posts WHERE id <> 't3_0' AND NOT (subreddit = 'wallstreetbets'
  AND regexp_matches(title, '(daily discussion|what are your moves|moves for)', 'i')))
SELECT id, pass, created_utc + to_minutes(low) AS due_from, created_utc + to_minutes(high) AS due_until
FROM awaited, passes
WHERE created_utc + to_minutes(low) <= (SELECT max(created_utc) - INTERVAL 10 MINUTE FROM awaited)
  AND NOT (pass = '1h' AND first_done)""",
)
def due_pass_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log says that every second post has had its first pass."""
    posts = frame(spark, sf_dir, "b_due_posts")
    value = F.when(F.col("first_done"), "done").otherwise("pending")
    done = posts.select(
        F.col("id").alias("post_id"), F.lit("1h").alias("pass"), value.alias("value"),
        (F.col("created_utc") + F.expr("INTERVAL 1 HOUR")).alias("updated_at"))
    arriving = stream(spark, sf_dir, "b_due_posts")
    return finished(passes.due_passes(arriving, done, current_thread=F.lit("t3_0")), "passes")
