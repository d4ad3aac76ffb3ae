"""Queries of the load and mining steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.operators import archive, mapping, mining, quality
from mentionlake.operators.keyed_write import (
    first_wins,
    insert_ignore,
    latest_by_key,
    upsert_mutable,
)
from mentionlake.plans.bindings import ctes, frame
from mentionlake.plans.registry import query
from mentionlake.session import new_folder
from mentionlake.sources import candidates, jsonl

TOKENS = r"""
texts AS (
  SELECT body AS t FROM b_comments
  WHERE body IS NOT NULL AND body NOT IN ('[deleted]', '[removed]')
    AND created_utc >= TIMESTAMP '2020-01-01'
  UNION ALL
  SELECT coalesce(title, '') || ' ' || coalesce(selftext, '') FROM b_posts
  WHERE created_utc >= TIMESTAMP '2020-01-01'),
caps AS (
  SELECT sym, count(*) AS n FROM (
    SELECT unnest(string_split_regex(t, '[^\p{L}\p{N}\p{M}_]+')) AS sym FROM texts)
  WHERE regexp_full_match(sym, '[A-Z]{2,5}') GROUP BY sym),
cash AS (
  SELECT sym, count(*) AS n FROM (
    SELECT upper(regexp_extract(p, '^([A-Za-z]{1,5})(?:[^\p{L}\p{N}\p{M}_]|$)', 1)) AS sym
    FROM (SELECT unnest(string_split(t, '$')[2:]) AS p FROM texts))
  WHERE sym <> '' GROUP BY sym),
mined AS (
  SELECT symbol, cashtag_count, allcaps_count, cashtag_count + allcaps_count AS total_count,
    CASE WHEN cashtag_count > 0 AND allcaps_count > 0 THEN 'cashtag+allcaps'
      WHEN cashtag_count > 0 THEN 'cashtag' ELSE 'allcaps' END AS evidence, 'review' AS action
  FROM (SELECT coalesce(cash.sym, caps.sym) AS symbol, coalesce(cash.n, 0) AS cashtag_count,
      coalesce(caps.n, 0) AS allcaps_count
    FROM cash FULL OUTER JOIN caps ON cash.sym = caps.sym)
  WHERE cashtag_count + allcaps_count >= 50 AND regexp_full_match(symbol, '[A-Z]{1,5}')
    AND symbol NOT IN (SELECT symbol FROM b_tickers))"""
MINED = f"WITH {ctes('b_posts', 'b_comments', 'b_tickers')}, {TOKENS} SELECT * FROM mined"


def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.mine_tokens(
        frame(spark, sf_dir, "b_comments"),
        frame(spark, sf_dir, "b_posts"),
        frame(spark, sf_dir, "b_tickers"),
    )


query("mine_tokens", MINED)(mined)


@query("review_csv", MINED)
def review_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined candidates through the review file."""
    path = new_folder(spark, "review")
    candidates.write_review(mined(spark, sf_dir), path)
    return candidates.read_review(spark, path)


# ---- archive lines --------------------------------------------------------------------------


def comment_lines(comments: DataFrame, score_shift: int = 0) -> DataFrame:
    """Comments as dump lines, with the irregularities dumps have.

    A third has no ``name``, missing authors are ``[deleted]``, some creation times are text, and
    bodies of even scores carry a NUL character.
    """
    bare = F.col("score") % 3 == 0
    odd = F.col("score") % 2 == 1
    created = F.unix_seconds("created_utc")
    fields = [
        F.when(~bare, F.col("id")).alias("name"),
        F.regexp_replace("id", "^t1_", "").alias("id"),
        F.col("post_id").alias("link_id"),
        "parent_id",
        F.initcap("subreddit").alias("subreddit"),
        F.coalesce("author", F.lit("[deleted]")).alias("author"),
        F.when(odd, F.col("body")).otherwise(F.concat(F.lit("\x00"), "body")).alias("body"),
        (F.col("score") + score_shift).alias("score"),
        (created + 86400).alias("retrieved_on"),
    ]
    as_text = F.to_json(F.struct(*fields, created.cast("string").alias("created_utc")))
    as_number = F.to_json(F.struct(*fields, created.alias("created_utc")))
    return comments.select(F.when(odd, as_text).otherwise(as_number).alias("value"), "id")


def post_lines(posts: DataFrame) -> DataFrame:
    value = F.to_json(
        F.struct(
            F.col("id").alias("name"),
            F.regexp_replace("id", "^t3_", "").alias("id"),
            "subreddit",
            F.coalesce("author", F.lit("[deleted]")).alias("author"),
            F.coalesce("title", F.lit("")).alias("title"),
            "selftext",
            "score",
            "num_comments",
            F.unix_seconds("created_utc").cast("double").alias("created_utc"),
        )
    )
    return posts.select(value.alias("value"), "id")


def as_lines(df: DataFrame, rank: int = 0) -> DataFrame:
    """Lines without a file behind them."""
    return df.select(
        F.lit(rank).alias("source_rank"),
        F.lit("lines").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


EVERY_FORUM = quality.LoadFilter(subreddits=())
ONE_FORUM = quality.LoadFilter(["user"], "2024-01-02", "2024-01-03")


@query(
    "load_status_counts",
    f"""WITH {ctes('b_comments')},
lines AS (
  SELECT concat('dump-', subreddit) AS file, CASE WHEN subreddit <> 'user' THEN 'filtered'
    WHEN CAST(created_utc AS DATE) NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-03' THEN 'filtered'
    ELSE 'matched' END AS status FROM b_comments
  UNION ALL
  SELECT concat('dump-', subreddit), CASE score WHEN -1 THEN 'malformed' WHEN 0 THEN 'malformed'
    WHEN 1 THEN 'blank' WHEN 2 THEN 'malformed' WHEN 3 THEN
      CASE WHEN CAST(created_utc AS DATE) NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-03'
        THEN 'filtered' ELSE 'malformed' END
    ELSE 'filtered' END FROM b_comments)
SELECT file, CAST(count(DISTINCT file) AS BIGINT) AS files, count(*) AS read,
  count(*) FILTER (status = 'matched') AS matched,
  count(*) FILTER (status = 'malformed') AS skipped_malformed,
  count(*) FILTER (status = 'filtered') AS skipped_filter
FROM lines GROUP BY ROLLUP (file)""",
)
def load_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over every comment line and, for every comment, one line with a defect."""
    comments = frame(spark, sf_dir, "b_comments")
    file = F.concat(F.lit("dump-"), "subreddit").alias("file")
    created = F.unix_seconds("created_utc")
    no_parent = F.to_json(F.struct("id", F.lit("user").alias("subreddit"), created.alias("created_utc")))
    defect = (
        F.when(F.col("score") == -1, F.lit("{not valid json"))
        .when(F.col("score") == 0, F.lit("[1, 2]"))
        .when(F.col("score") == 1, F.lit(" \t "))
        .when(F.col("score") == 2, F.lit('{"id":"x","link_id":"y","subreddit":"user","created_utc":"soon"}'))
        .when(F.col("score") == 3, no_parent)
        .otherwise(F.lit('{"id":"x","link_id":"y","subreddit":"elsewhere","created_utc":1}'))
    )
    good = comments.join(comment_lines(comments), "id").select(file, "value")
    lines = good.unionByName(comments.select(file, defect.alias("value")))
    return quality.load_counts(archive.classify_lines(lines, "comments", ONE_FORUM))


MAPPED_COMMENTS = f"""WITH {ctes('b_comments')}
SELECT id, post_id, subreddit, author, body, score, created_utc FROM b_comments"""


@query("map_comments", MAPPED_COMMENTS)
def map_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment twice in the dump, the second time with another score: the first one counts."""
    comments = frame(spark, sf_dir, "b_comments")
    lines = as_lines(comment_lines(comments), 0).unionByName(
        as_lines(comment_lines(comments, score_shift=100), 1)
    )
    rows = mapping.map_comments(archive.classify_lines(lines, "comments", EVERY_FORUM))
    return first_wins(rows, archive.KEYS, jsonl.ORDER).drop("raw", *jsonl.ORDER)


@query(
    "map_posts",
    f"""WITH {ctes('b_posts')}
SELECT id, subreddit, author, coalesce(title, '') AS title, selftext, score, num_comments, created_utc
FROM b_posts""",
)
def map_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = as_lines(post_lines(frame(spark, sf_dir, "b_posts")))
    rows = mapping.map_posts(archive.classify_lines(lines, "posts", EVERY_FORUM))
    return first_wins(rows, archive.KEYS, jsonl.ORDER).drop("raw", *jsonl.ORDER)


@query(
    "payload_staleness",
    f"""WITH {ctes('b_comments')}
SELECT id, parent_id, CAST(epoch(created_utc) AS BIGINT) + 86400 AS retrieved_on,
  CAST(86400 AS BIGINT) AS staleness_sec FROM b_comments""",
)
def payload_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = as_lines(comment_lines(frame(spark, sf_dir, "b_comments")))
    rows = mapping.map_comments(archive.classify_lines(lines, "comments", EVERY_FORUM))
    return mapping.payload_staleness(rows)


@query(
    "kind_detect",
    f"""WITH {ctes('b_comments', 'b_posts')}
SELECT 'comments' AS kind, count(*) AS n FROM b_comments
UNION ALL SELECT 'posts', count(*) FROM b_posts""",
)
def kind_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per kind of a folder of dumps, each file's kind taken from its first object."""
    folder = new_folder(spark, "dumps")
    comment_lines(frame(spark, sf_dir, "b_comments")).select("value").write.text(f"{folder}/a")
    post_lines(frame(spark, sf_dir, "b_posts")).select("value").write.text(f"{folder}/b")
    files = jsonl.list_files([f"{folder}/a", f"{folder}/b"])
    kinds = quality.file_kinds(jsonl.read_heads(spark, files))
    lines = quality.with_kind(jsonl.read_files(spark, files), kinds, len(files))
    return lines.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _loaded(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    frames = [
        spark.read.parquet(path).select(
            F.lit(kind).alias("kind"), "id", "subreddit", "author", "score", "created_utc"
        )
        for kind, path in tables.items()
    ]
    return frames[0].unionByName(frames[1])


LOADED = f"""WITH {ctes('b_comments', 'b_posts')}
SELECT 'comments' AS kind, id, subreddit, author, score, created_utc FROM b_comments
UNION ALL SELECT 'posts', id, subreddit, author, score, created_utc FROM b_posts"""


@query("archive_load", LOADED)
def archive_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of dump loaded into their tables, twice: the second load adds nothing."""
    folder = new_folder(spark, "dumps")
    comment_lines(frame(spark, sf_dir, "b_comments")).select("value").write.text(f"{folder}/a")
    post_lines(frame(spark, sf_dir, "b_posts")).select("value").write.text(f"{folder}/b")
    out = new_folder(spark, "raw")
    tables = {"comments": f"{out}/comments", "posts": f"{out}/posts"}
    for _ in range(2):
        archive.load_archive(spark, [f"{folder}/a", f"{folder}/b"], tables, wanted=EVERY_FORUM)
    return _loaded(spark, tables)


def write_zstd(lines: DataFrame, folder: str) -> None:
    """Each partition as one zstd file with a 256 MiB window, more than the JVM codec reads."""

    def pack(batches):
        import zstandard
        from pyspark import TaskContext

        from mentionlake.sources.longzstd import open_filesystem

        files, inner, _ = open_filesystem(f"{folder}/part-{TaskContext.get().partitionId():05d}.jsonl.zst")
        files.create_dir(inner.rsplit("/", 1)[0])
        setup = zstandard.ZstdCompressionParameters.from_level(3, window_log=28)
        with files.open_output_stream(inner, compression=None) as raw:
            with zstandard.ZstdCompressor(compression_params=setup).stream_writer(raw) as packed:
                for batch in batches:
                    for value in batch.column(0):
                        packed.write(value.as_py().encode() + b"\n")
                    yield batch.slice(0, 0)

    lines.select("value").mapInArrow(pack, "value string").write.format("noop").mode("overwrite").save()


@query("zstd_load", MAPPED_COMMENTS)
def zstd_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-window zstd dumps of every comment, decompressed, mapped and de-duplicated."""
    folder = new_folder(spark, "zstd")
    write_zstd(comment_lines(frame(spark, sf_dir, "b_comments")), folder)
    files = jsonl.list_files([folder])
    spread = spark.sparkContext.defaultParallelism
    lines = jsonl.read_files(spark, files, spread=spread)
    rows = mapping.map_comments(archive.classify_lines(lines, "comments", EVERY_FORUM))
    return first_wins(rows, archive.KEYS, jsonl.ORDER).drop("raw", *jsonl.ORDER)


# ---- keyed writes ---------------------------------------------------------------------------

# first load: what existed at the end of 1 January; second load: everything, with newer numbers
FIRST_LOAD = "created_utc < TIMESTAMP '2024-01-02 00:00:00'"


@query(
    "insert_ignore",
    f"""WITH {ctes('b_comments')}
SELECT id, created_utc, author, score + 100 AS score FROM b_comments WHERE NOT ({FIRST_LOAD})""",
)
def insert_ignore_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = frame(spark, sf_dir, "b_comments").select("id", "created_utc", "author", "score")
    later = comments.withColumn("score", F.col("score") + 100)
    again = later.unionByName(comments.withColumn("score", F.col("score") + 200))
    return insert_ignore(comments.filter(FIRST_LOAD), again, archive.KEYS, ["score"])


@query(
    "upsert_post_mutable",
    f"""WITH {ctes('b_posts')}
SELECT id, created_utc, CASE WHEN {FIRST_LOAD} THEN title ELSE upper(title) END AS title,
  score + 7 AS score, CASE WHEN num_comments % 5 = 0 THEN NULL ELSE num_comments * 2 END AS num_comments
FROM b_posts""",
)
def upsert_post_mutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = frame(spark, sf_dir, "b_posts").select("id", "created_utc", "title", "score", "num_comments")
    polled = posts.select(
        "id",
        "created_utc",
        F.upper("title").alias("title"),
        (F.col("score") + 7).alias("score"),
        F.when(F.col("num_comments") % 5 != 0, F.col("num_comments") * 2).alias("num_comments"),
        F.lit(1).alias("poll"),
    )
    return upsert_mutable(
        posts.filter(FIRST_LOAD), polled, archive.KEYS, ["score", "num_comments"], ["poll"]
    )


@query(
    "upsert_comment_score",
    f"""WITH {ctes('b_comments')}
SELECT id, created_utc, CASE WHEN {FIRST_LOAD} THEN author ELSE 'first' END AS author,
  score + 2 AS score FROM b_comments""",
)
def upsert_comment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls of every comment after the first load; the last poll's score stays."""
    comments = frame(spark, sf_dir, "b_comments").select("id", "created_utc", "author", "score")

    def poll(number: int, author: str) -> DataFrame:
        changed = {"author": F.lit(author), "score": F.col("score") + number, "poll": F.lit(number)}
        return comments.withColumns(changed)

    polls = poll(1, "first").unionByName(poll(2, "second"))
    return upsert_mutable(comments.filter(FIRST_LOAD), polls, archive.KEYS, ["score"], ["poll"])


@query(
    "kv_latest",
    """SELECT concat('cursor:', user_id) AS key,
  arg_max(props, (ts, event_id)) AS value, arg_max(ts, (ts, event_id)) AS updated_at,
  arg_max(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY 1""",
)
def kv_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("cursor:"), "user_id").alias("key"),
        F.col("props").alias("value"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        "event_id",
    )
    return latest_by_key(log, ["key"], ["updated_at", "event_id"])
