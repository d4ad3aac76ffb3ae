"""Queries of classification and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import text as tx
from mentionlake.operators import classify as cl, hits, promote as pr, universe
from mentionlake.operators.keyed_write import first_wins
from mentionlake.plans.bindings import ctes, frame
from mentionlake.plans.registry import query
from mentionlake.plans.universe import (
    KNOWN,
    MERGED,
    NAMES,
    known_tickers,
    merged_listings,
    normalized,
)
from mentionlake.session import materialize, new_folder
from mentionlake.sources import candidates as files

MIN_CASHTAG = 20
FALSE_BASES = str(fixed.FOREIGN_FALSE_BASES)
CONFIDENT = str(fixed.CONFIDENT_EQUITY)
ALIASES = f"(VALUES {', '.join(str(pair) for pair in fixed.KNOWN_ALIASES.items())})"
STOPPED = "(SELECT symbol FROM b_stoplist)"


def _flags(table: str) -> str:
    return f"""(SELECT *, symbol IN {STOPPED} AS stopped,
    base IN {STOPPED} OR base IN {FALSE_BASES} AS base_hit
  FROM (SELECT *, regexp_replace(symbol, '^(.+)[FYQ]$', '\\1') AS base FROM {table}))"""


DROP = f"""CASE WHEN stopped THEN 'symbol_in_stoplist'
    WHEN base_hit AND NOT (symbol LIKE '%F' AND cashtag_count > 0 AND allcaps_count <= 10 * cashtag_count)
      THEN 'base_in_slang_or_common:' || base
    WHEN cashtag_count > 0 AND allcaps_count > 10 * cashtag_count AND (base_hit OR symbol IN {FALSE_BASES})
      THEN 'high_allcaps_and_slang' END"""

FOREIGN = "(regexp_full_match(symbol, '.{3,}[FY]') OR regexp_full_match(symbol, '.{4}[FYQ]'))"

CLASSIFIED_CTES = ctes(
    "b_candidates", "b_sec", "b_equity", "b_coins", "b_stoplist", "b_filings", "b_tickers"
)
CLASSIFIED = f"""
hits AS (
  SELECT symbol, array_to_string(list_sort(list(DISTINCT source)), ';') AS sources,
    array_to_string(list_sort(list(DISTINCT name))[:5], ' | ') AS names
  FROM (SELECT symbol, source, name FROM b_sec UNION ALL SELECT symbol, source, name FROM b_equity)
  GROUP BY symbol),
coins AS (
  SELECT symbol, array_to_string(list_sort(list(DISTINCT name))[:5], ' | ') AS names FROM b_coins
  WHERE regexp_full_match(symbol, '[A-Z0-9]{{1,5}}') GROUP BY symbol),
ruled AS (
  SELECT c.*, h.sources AS eq_sources, h.names AS eq_names, k.names AS coin_names, a.target, f.hit, f.label,
    {DROP} AS drop_reason, {FOREIGN} AS is_foreign,
    CASE WHEN h.symbol IS NOT NULL THEN CASE WHEN stopped OR length(c.symbol) <= 1 THEN 1 ELSE 2 END
      WHEN stopped THEN 3
      WHEN {FOREIGN} AND {DROP} IS NOT NULL THEN 4
      WHEN {FOREIGN} THEN 5
      WHEN k.symbol IS NOT NULL THEN 6
      WHEN c.symbol IN {CONFIDENT} THEN 7
      WHEN a.symbol IS NOT NULL THEN 8
      WHEN f.hit THEN 9
      WHEN cashtag_count >= 200 THEN 10 ELSE 11 END AS rule
  FROM {_flags('b_candidates')} AS c LEFT JOIN hits AS h USING (symbol)
    LEFT JOIN coins AS k USING (symbol) LEFT JOIN b_filings AS f USING (symbol)
    LEFT JOIN {ALIASES} AS a(symbol, target) USING (symbol)
  WHERE cashtag_count >= {MIN_CASHTAG}),
classified AS (
  SELECT symbol, cashtag_count, allcaps_count, total_count, evidence,
    CASE rule WHEN 1 THEN 'ambiguous' WHEN 3 THEN 'stoplist' WHEN 4 THEN 'stoplist'
      WHEN 5 THEN 'review_foreign' WHEN 6 THEN 'crypto' WHEN 8 THEN 'alias' WHEN 11 THEN 'unrecognized'
      ELSE 'confirmed' END AS bucket,
    CASE rule WHEN 1 THEN 'equity_listing_match' WHEN 2 THEN 'equity_listing_match'
      WHEN 3 THEN 'slang_or_profanity' WHEN 4 THEN 'foreign_suffix_false_positive:' || drop_reason
      WHEN 5 THEN suffix WHEN 6 THEN 'coingecko_symbol' WHEN 7 THEN 'human_confident_equity'
      WHEN 8 THEN 'alias_of:' || target WHEN 9 THEN 'sec_edgar_fulltext' WHEN 10 THEN 'high_cashtag_spotcheck'
      ELSE 'unmatched_low_cashtag' END AS reason,
    CASE rule WHEN 1 THEN eq_sources WHEN 2 THEN eq_sources WHEN 3 THEN 'slang_stoplist'
      WHEN 4 THEN 'foreign_suffix_filter' WHEN 5 THEN suffix WHEN 6 THEN 'coingecko'
      WHEN 7 THEN 'manual_review_allowlist' WHEN 8 THEN 'known_alias_map' WHEN 9 THEN 'sec_efts'
      WHEN 10 THEN 'cashtag_threshold_200' ELSE '' END AS sources,
    CASE rule WHEN 1 THEN eq_names WHEN 2 THEN eq_names WHEN 6 THEN coin_names WHEN 8 THEN target
      WHEN 9 THEN label ELSE '' END AS matched_names,
    CASE rule WHEN 4 THEN 'ignore' WHEN 11 THEN 'ignore_or_manual' ELSE 'review' END AS action
  FROM (SELECT *, CASE WHEN length(symbol) = 5 AND symbol LIKE '%Q' THEN 'suffix_nasdaq_bankruptcy_Q'
    WHEN symbol LIKE '%Y' THEN 'suffix_adr_Y' ELSE 'suffix_foreign_F' END AS suffix FROM ruled))"""
ALL_CLASSIFIED = f"WITH {CLASSIFIED_CTES}, {CLASSIFIED} SELECT * FROM classified"


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    sec = frame(spark, sf_dir, "b_sec")
    coins = frame(spark, sf_dir, "b_coins").filter(F.col("symbol").rlike(r"^[\p{L}\p{N}]{1,5}$"))
    return cl.classify(
        frame(spark, sf_dir, "b_candidates"),
        equity=hits.symbol_hits(hits.all_hits(sec, frame(spark, sf_dir, "b_equity"))),
        sec=hits.symbol_hits(hits.all_hits(sec)),
        coins=hits.first_names(coins),
        stoplist=frame(spark, sf_dir, "b_stoplist"),
        filings=frame(spark, sf_dir, "b_filings"),
        min_cashtag=MIN_CASHTAG,
    )


query("classify_candidates", ALL_CLASSIFIED)(classified)


@query(
    "bucket_counts",
    f"WITH {CLASSIFIED_CTES}, {CLASSIFIED} SELECT bucket, count(*) AS n FROM classified GROUP BY bucket",
)
def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.bucket_counts(classified(spark, sf_dir))


@query("bucket_files", ALL_CLASSIFIED)
def bucket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified candidates through one CSV folder per bucket."""
    path = new_folder(spark, "buckets")
    files.write_buckets(classified(spark, sf_dir), path)
    return files.read_buckets(spark, path).select(*cl.COLUMNS)


@query(
    "foreign_suffix_filter",
    f"""WITH {ctes('b_foreign', 'b_stoplist')}
SELECT symbol, cashtag_count, allcaps_count, {FOREIGN} AS is_foreign, {DROP} AS drop_reason
FROM {_flags('b_foreign')}""",
)
def foreign_suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "b_foreign")
    rows = rows.withColumn("is_foreign", tx.is_foreign_suffix(F.col("symbol")))
    return cl.filter_foreign(rows, frame(spark, sf_dir, "b_stoplist"))


# review_foreign rows are judged again at promotion; here with their counts turned round, so that
# the second look drops some
PROMOTED = f"""
again AS (SELECT * REPLACE (1 AS cashtag_count, total_count AS allcaps_count) FROM classified
  WHERE bucket = 'review_foreign'),
judged AS (SELECT *, {DROP} AS drop_reason FROM {_flags('again')}),
dropped AS (
  SELECT symbol, cashtag_count, allcaps_count, total_count, evidence, 'stoplist' AS bucket,
    'foreign_suffix_false_positive:' || drop_reason AS reason, 'foreign_suffix_filter' AS sources,
    '' AS matched_names, 'ignore' AS action FROM judged WHERE drop_reason IS NOT NULL),
listed AS (
  SELECT symbol, CASE WHEN trim(split_part(matched_names, '|', 1)) <> ''
      THEN trim(split_part(matched_names, '|', 1)) ELSE 'Corpus-mined (' || reason || ')' END AS name,
    CASE WHEN reason LIKE '%bankruptcy\\_Q%' ESCAPE '\\' THEN 'OTC-BANKRUPTCY'
      WHEN reason LIKE '%suffix\\_adr\\_Y%' ESCAPE '\\' OR reason LIKE '%suffix\\_foreign\\_F%' ESCAPE '\\'
        THEN 'OTC-FOREIGN' ELSE 'CORPUS' END AS exchange, source_rank, cashtag_count
  FROM (SELECT symbol, cashtag_count, reason, matched_names, 0 AS source_rank FROM classified
      WHERE bucket = 'confirmed'
    UNION ALL SELECT symbol, cashtag_count, reason, matched_names, 1 FROM judged
      WHERE drop_reason IS NULL)),
new_tickers AS (
  SELECT symbol, name, exchange, false AS is_etf, true AS is_active, 'corpus_mined' AS ticker_source
  FROM listed WHERE symbol NOT IN (SELECT symbol FROM known))"""
PROMOTION = f"WITH {CLASSIFIED_CTES}, {CLASSIFIED}, {MERGED}, {KNOWN}, {NAMES}, {PROMOTED}"


def handed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classification as files, to be looked through before anything is promoted."""
    return materialize(classified(spark, sf_dir), "classified")


def promotion(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> pr.Promotion:
    rows = handed_over(spark, sf_dir) if rows is None else rows
    foreign = rows.filter("bucket = 'review_foreign'").withColumns(
        {"cashtag_count": F.lit(1).cast("bigint"), "allcaps_count": F.col("total_count")}
    )
    listings = merged_listings(spark, sf_dir)
    names = first_wins(
        universe.name_rows(listings), ["normalized_name"], ["group_rank", "line_no"]
    )
    return pr.promote(
        rows.filter("bucket = 'confirmed'"),
        foreign,
        stoplist=frame(spark, sf_dir, "b_stoplist"),
        tickers=known_tickers(spark, sf_dir),
        names=names,
    )


@query("promote", f"{PROMOTION} SELECT * FROM new_tickers")
def promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promotion(spark, sf_dir).new_tickers


@query(
    "promote_names",
    f"""{PROMOTION},
fresh AS (
  SELECT symbol, normalized_name, row_number() OVER (PARTITION BY normalized_name
    ORDER BY source_rank, cashtag_count DESC, symbol) AS rn
  FROM (SELECT *, {normalized('name')} AS normalized_name FROM listed)
  WHERE normalized_name <> '')
SELECT normalized_name, symbol FROM fresh
WHERE rn = 1 AND normalized_name NOT IN (SELECT normalized_name FROM names)""",
)
def promote_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promotion(spark, sf_dir).new_names


@query(
    "promote_verify",
    f"""{PROMOTION},
after AS (SELECT * FROM known UNION ALL SELECT * FROM new_tickers)
SELECT 'before' AS metric, ticker_source AS item, count(*) AS n FROM known GROUP BY ticker_source
UNION ALL SELECT 'after', ticker_source, count(*) FROM after GROUP BY ticker_source
UNION ALL SELECT 'promoted', '', count(*) FROM listed
UNION ALL SELECT 'present', '', count(*) FROM after WHERE symbol IN (SELECT symbol FROM listed)
UNION ALL SELECT 'dropped_but_mined', '', count(*) FROM after
  WHERE ticker_source = 'corpus_mined' AND symbol IN (SELECT symbol FROM dropped)""",
)
def promote_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.verification(known_tickers(spark, sf_dir), promotion(spark, sf_dir))


@query(
    "stoplist_merge",
    f"""{PROMOTION},
stop_rows AS (SELECT * FROM classified WHERE bucket = 'stoplist')
SELECT *, false AS is_new FROM stop_rows WHERE symbol NOT IN (SELECT symbol FROM dropped)
UNION ALL SELECT *, symbol NOT IN (SELECT symbol FROM stop_rows) FROM dropped""",
)
def stoplist_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = handed_over(spark, sf_dir)
    stop_rows = rows.filter("bucket = 'stoplist'")
    return pr.merge_stoplist(stop_rows, promotion(spark, sf_dir, rows).dropped)
