"""The pipeline's tables expressed over the driver's tables.

Each binding is one SELECT that both engines run; ``TS<<seconds>>`` stands for the one call that
differs. ``frame`` gives the Spark DataFrame, ``ctes`` the same text as WITH clauses for the oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BINDINGS = {
    "b_posts": """
SELECT concat('t3_', doc_id) AS id, lang AS subreddit,
  CASE WHEN doc_id % 10 = 0 THEN NULL ELSE source END AS author,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat('$', CASE doc_id % 4 WHEN 0 THEN 'gme'
    WHEN 1 THEN 'ABCDE' WHEN 2 THEN 'Toolong' ELSE 'X' END) END AS title,
  text AS selftext, CAST(n_chars % 100 AS INT) AS score, CAST(n_chars % 30 AS INT) AS num_comments,
  TS<<1704067200 + doc_id * 60>> AS created_utc
FROM {documents}""",
    "b_comments": """
SELECT concat('t1_', conv_id, '_', turn) AS id, concat('t3_', conv_id) AS post_id,
  CASE WHEN turn = 0 THEN concat('t3_', conv_id)
    ELSE concat('t1_', conv_id, '_', CAST(floor((turn - 1) / 2.0) AS BIGINT)) END AS parent_id,
  role AS subreddit,
  CASE WHEN conv_id % 9 = 0 THEN NULL ELSE concat('u', conv_id % 40) END AS author,
  CASE WHEN conv_id % 11 = 0 THEN '[removed]' WHEN turn = 5 THEN NULL
    ELSE concat(text, ' $gme TSLA x$A') END AS body,
  CAST(turn - 1 AS INT) AS score,
  TS<<1704067200 + conv_id * 3600 + turn * 600>> AS created_utc
FROM {conversations}""",
    "b_capture": """
SELECT event_id, concat('t3_', user_id % 20) AS thread_id, ts AS polled_at,
  CASE WHEN user_id % 13 = 0 THEN NULL ELSE CAST(100 + user_id AS INT) END AS num_comments_reported,
  CAST(90 + user_id % 50 AS INT) AS comments_in_db_for_thread,
  CAST(floor(value) AS INT) AS fetched_this_cycle, event_type = 'error' AS was_truncated
FROM {events}""",
    "b_polls": """
SELECT event_id, concat('t3_', user_id % 20) AS thread_id, ts AS polled_at,
  event_type IN ('error', 'view', 'click') AS was_truncated,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS max_seen_utc,
  CASE WHEN user_id % 13 = 0 THEN NULL ELSE CAST(100 + user_id AS INT) END AS num_comments_reported,
  CAST(floor(value) AS INT) AS fetched_this_cycle
FROM {events}""",
    "b_sparse_polls": """
SELECT event_id, concat('t3_', user_id % 20) AS thread_id, ts AS polled_at,
  CASE WHEN user_id % 13 = 0 THEN NULL ELSE CAST(100 + user_id AS INT) END AS num_comments_reported
FROM {events} WHERE event_id % 10 = 0""",
    "b_drain_polls": """
SELECT concat('t3_', CAST(CAST(ts AS DATE) - CAST(user_id % 3 AS INT) AS VARCHAR(10))) AS thread_id,
  ts AS polled_at, event_id,
  CASE WHEN floor(value) % 3 = 0 THEN CAST(floor(value) AS INT) ELSE 0 END AS ingested
FROM {events}""",
    "b_primary_log": """
SELECT DISTINCT 'daily' AS subreddit, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS polled_at,
  concat('t3_', CAST(CAST(ts AS DATE) AS VARCHAR(10))) AS thread_id
FROM {events}""",
    "b_event_comments": """
SELECT event_id, concat('t1_', event_id) AS id, concat('t3_', user_id % 25) AS post_id,
  ts AS created_utc
FROM {events}""",
    "b_listings": """
SELECT concat(chr(CAST(65 + p_partkey % 26 AS INT)),
    chr(CAST(65 + CAST(floor(p_partkey / 26.0) AS BIGINT) % 26 AS INT)),
    CASE WHEN p_partkey % 3 = 0 THEN 'F' ELSE '' END) AS symbol,
  concat(p_name, CASE p_partkey % 5 WHEN 0 THEN ' Inc. Common Stock' WHEN 1 THEN ' Holdings Ltd.'
    WHEN 2 THEN ', Inc. - Class A Common Stock' WHEN 3 THEN ' Corp (ADR)' ELSE '' END) AS security_name,
  CASE p_size % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'P' WHEN 3 THEN 'Z' WHEN 4 THEN 'V'
    ELSE 'Q' END AS exchange_code,
  CASE WHEN p_partkey % 17 = 0 THEN 'Y' ELSE 'N' END AS test_issue,
  CASE WHEN p_type = 'ECONOMY' THEN 'Y' ELSE 'N' END AS etf, p_partkey AS line_no
FROM {part}""",
    "b_tickers": "SELECT DISTINCT upper(lang) AS symbol FROM {documents}",
    "b_stoplist": """
SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS symbol FROM {part}
UNION SELECT upper(lang) AS symbol FROM {documents}""",
    "b_candidates": """
SELECT symbol, CAST(sum(cash) AS BIGINT) AS cashtag_count, CAST(sum(caps) AS BIGINT) AS allcaps_count,
  CAST(sum(cash + caps) AS BIGINT) AS total_count, 'cashtag+allcaps' AS evidence
FROM (
  SELECT CASE p_partkey % 20 WHEN 0 THEN 'RDBX' WHEN 1 THEN 'APPL' WHEN 2 THEN 'TSLAQ'
      WHEN 3 THEN 'BABYF' WHEN 4 THEN 'BECKY' WHEN 5 THEN 'GAY'
      WHEN 6 THEN upper(split_part(p_name, ' ', 1)) WHEN 7 THEN upper(split_part(p_name, ' ', 2))
      WHEN 8 THEN concat(upper(split_part(p_name, ' ', 1)), 'Y') WHEN 9 THEN concat(pair, 'AF')
      WHEN 10 THEN concat(pair, 'ABQ') WHEN 11 THEN concat(pair, 'AC') WHEN 12 THEN concat(pair, 'BY')
      ELSE concat(pair, CASE WHEN p_partkey % 3 = 0 THEN 'F' ELSE '' END) END AS symbol,
    p_size AS cash, p_size * (p_partkey % 23) AS caps
  FROM (SELECT *, concat(chr(CAST(65 + p_partkey % 26 AS INT)),
    chr(CAST(65 + CAST(floor(p_partkey / 26.0) AS BIGINT) % 26 AS INT))) AS pair FROM {part}) AS p
) AS c GROUP BY symbol""",
    "b_equity": """
SELECT symbol, concat('wayback_', 2020 + line_no % 6, '_otherlisted') AS source,
  security_name AS name, exchange_code AS exchange FROM b_listings WHERE etf = 'N'""",
    "b_sec": """
SELECT symbol, concat('sec_exchange:', CASE WHEN line_no % 2 = 0 THEN 'OTC' ELSE 'NYSE' END) AS source,
  security_name AS name, CASE WHEN line_no % 2 = 0 THEN 'OTC' ELSE 'NYSE' END AS exchange
FROM b_listings WHERE exchange_code = 'V'""",
    "b_coins": "SELECT upper(split_part(p_name, ' ', 2)) AS symbol, p_brand AS name FROM {part}",
    "b_filings": """
SELECT concat(chr(CAST(65 + p_partkey % 26 AS INT)),
    chr(CAST(65 + CAST(floor(p_partkey / 26.0) AS BIGINT) % 26 AS INT)), 'AC') AS symbol,
  max(p_size) > 40 AS hit, max(p_brand) AS label
FROM {part} GROUP BY 1""",
    "b_foreign": """
SELECT symbol, CAST(sum(cash) AS BIGINT) AS cashtag_count, CAST(sum(caps) AS BIGINT) AS allcaps_count
FROM (
  SELECT concat(symbol, 'AB', CASE line_no % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'Y' ELSE 'Q' END) AS symbol,
    p_size AS cash, p_size * (p_partkey % 23) AS caps
  FROM b_listings JOIN {part} ON p_partkey = line_no
  UNION ALL
  SELECT concat(upper(split_part(p_name, ' ', 1)), CASE p_partkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'Y'
    ELSE 'Q' END), p_size, p_size * (p_partkey % 23) FROM {part}
  UNION ALL
  SELECT CASE p_partkey % 4 WHEN 0 THEN 'BABYF' WHEN 1 THEN 'BECKY' WHEN 2 THEN 'GAY' ELSE 'TSLAQ' END,
    p_size, p_size * (p_partkey % 29) FROM {part}
) AS f GROUP BY symbol""",
    "b_ingest_log": """
SELECT ts, CASE event_type WHEN 'signup' THEN 'posts' WHEN 'view' THEN 'comments'
    WHEN 'click' THEN 'requests' ELSE 'other' END AS kind,
  CAST(CASE WHEN event_type = 'click' THEN floor(value * 40) ELSE floor(value) END AS BIGINT) AS n
FROM {events}""",
    "b_quiet_log": """
SELECT ts, CASE event_type WHEN 'signup' THEN 'posts' WHEN 'view' THEN 'comments'
    WHEN 'click' THEN 'requests' ELSE 'other' END AS kind, CAST(floor(value) AS BIGINT) AS n
FROM {events} WHERE extract(hour FROM ts) NOT BETWEEN 2 AND 6""",
    "b_due_posts": """
SELECT concat('t3_', doc_id) AS id, CASE WHEN lang = 'en' THEN 'wallstreetbets' ELSE lang END AS subreddit,
  CASE WHEN n_chars % 4 = 0 THEN concat('Daily Discussion Thread ', doc_id) ELSE 'other' END AS title,
  n_chars % 2 = 0 AS first_done, TS<<1704067200 + doc_id * 60>> AS created_utc
FROM {documents}""",
    "b_hot_posts": """
SELECT id, subreddit, CASE num_comments % 4 WHEN 0 THEN concat('Daily Discussion Thread ', id)
    WHEN 1 THEN 'What Are Your MOVES Tomorrow' WHEN 2 THEN 'weekend moves for you' ELSE title END AS title,
  num_comments % 3 = 0 AS stickied, 100 - score AS hot_rank
FROM b_posts""",
    "b_cursors": """
SELECT post_id, CASE WHEN turns % 4 = 0 THEN NULL ELSE started + INTERVAL 25 MINUTE
    + make_hours * (turns % 4 - 1) END AS cursor_utc
FROM (SELECT post_id, min(created_utc) AS started, count(*) AS turns, INTERVAL 7 HOUR AS make_hours
  FROM b_comments GROUP BY post_id) AS t""",
    "b_tree": """
SELECT id, parent_id, post_id, created_utc FROM b_comments
UNION ALL
SELECT concat(id, '_late'), id, post_id, created_utc + INTERVAL 11 HOUR FROM b_comments""",
}

_TS = re.compile(r"TS<<(.*?)>>")


def spark_sql(text: str) -> str:
    return _TS.sub(r"timestamp_seconds(\1)", text)


def duckdb_sql(text: str) -> str:
    return _TS.sub(r"make_timestamp((\1) * 1000000)", text)


def tables_in(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def uses(name: str) -> list[str]:
    """The bindings this one reads, in order of definition, itself last."""
    found = [n for n in re.findall(r"\bb_\w+", BINDINGS[name]) if n in BINDINGS]
    return list(dict.fromkeys([m for n in found for m in uses(n)] + [name]))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """DataFrame of a binding, with the driver's zone-less timestamps read as UTC instants."""
    used = uses(name)
    text = f"WITH {', '.join(f'{n} AS ({BINDINGS[n]})' for n in used[:-1])} {BINDINGS[name]}"
    text = spark_sql(text if used[:-1] else BINDINGS[name])
    inputs = {}
    for table in tables_in(text):
        df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for field, kind in df.dtypes:
            if kind == "timestamp_ntz":
                df = df.withColumn(field, df[field].cast("timestamp"))
        inputs[table] = df
    return spark.sql(text, **inputs)


def ctes(*names: str) -> str:
    """WITH items for the oracle: the bindings and those they build on."""
    items = []
    for name in dict.fromkeys(n for wanted in names for n in uses(wanted)):
        text = re.sub(r"\{(\w+)\}", r"\1", duckdb_sql(BINDINGS[name]))
        items.append(f"{name} AS ({text})")
    return ",\n".join(items)
