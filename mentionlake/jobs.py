"""The pipeline's steps from paths to paths, in the order they are run.

``operators.archive.load_archive`` comes first. Between classification and promotion the bucket files
are meant to be looked through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mentionlake import fixed_values as fixed
from mentionlake.operators import capture, classify as cl, hits, mining, promote as pr, snapshots, universe
from mentionlake.session import materialize
from mentionlake.sources import candidates as files, listings, reference_lists

TICKERS = (
    "symbol string, name string, exchange string, is_etf boolean, is_active boolean, "
    "ticker_source string"
)
NAMES = "normalized_name string, symbol string"


@dataclass(frozen=True)
class UniverseTables:
    """Folders of the ticker and the name table."""

    tickers: str
    names: str


def load_universe(
    spark: SparkSession, nasdaq: str, other: str, tables: UniverseTables
) -> tuple[int, int]:
    """Both symbol directories into the ticker and name tables; returns how many of each they hold."""
    groups = [listings.read_nasdaq_listed(spark, nasdaq), listings.read_other_listed(spark, other)]
    merged = materialize(universe.merge_listings(groups, listings.ORDER), "listings")
    order = ["group_rank", *listings.ORDER]
    tickers = snapshots.read(spark, tables.tickers, TICKERS)
    names = snapshots.read(spark, tables.names, NAMES)
    written = (
        snapshots.write(universe.upsert_tickers(tickers, merged, order), tables.tickers),
        snapshots.write(universe.upsert_ticker_names(names, merged, order), tables.names),
    )
    return written[0].count(), written[1].count()


def mine(
    spark: SparkSession,
    comments: str,
    posts: str,
    tables: UniverseTables,
    out: str,
    *,
    min_count: int = fixed.MIN_TOKEN_COUNT,
    start_date: str = fixed.MINE_START_DATE,
) -> None:
    """Review file of frequent tokens that are not known tickers."""
    found = mining.mine_tokens(
        spark.read.parquet(comments),
        spark.read.parquet(posts),
        snapshots.read(spark, tables.tickers, TICKERS),
        min_count=min_count,
        start_date=start_date,
    )
    files.write_review(found, out)


def classify(
    spark: SparkSession,
    review: str,
    lists: dict[str, str],
    out: str,
    *,
    min_cashtag: int = fixed.MIN_CASHTAG,
) -> DataFrame:
    """Bucket files from a review file; returns the number of candidates per bucket.

    ``lists`` names the reference lists: sec_map, sec_exchange, historical (folder), coins, stoplist
    and filings (CSV: symbol, hit, label).
    """
    sec = hits.all_hits(
        reference_lists.read_sec_map(spark, lists["sec_map"]),
        reference_lists.read_sec_exchange(spark, lists["sec_exchange"]),
    )
    historical = hits.all_hits(reference_lists.read_historical(spark, lists["historical"]))
    filings = spark.read.schema("symbol string, hit boolean, label string").csv(
        lists["filings"], header=True
    )
    rows = cl.classify(
        files.read_review(spark, review),
        equity=hits.symbol_hits(hits.all_hits(sec, historical)),
        sec=hits.symbol_hits(sec),
        coins=hits.first_names(reference_lists.read_coins(spark, lists["coins"])),
        stoplist=reference_lists.read_stoplist(spark, lists["stoplist"]),
        filings=filings,
        min_cashtag=min_cashtag,
    )
    files.write_buckets(rows, out)
    return cl.bucket_counts(files.read_buckets(spark, out))


def promote(
    spark: SparkSession,
    buckets: str,
    stoplist: str,
    tables: UniverseTables,
    out: str,
    *,
    dry_run: bool = False,
) -> DataFrame:
    """Promote confirmed and kept foreign candidates; returns the verification metrics.

    ``out`` receives the dropped candidates, the kept foreign ones and the merged stoplist rows. A
    dry run writes nothing; its metrics are those the run would give.
    """
    rows = files.read_buckets(spark, buckets).select(*cl.COLUMNS)
    words = reference_lists.read_stoplist(spark, stoplist)
    tickers = snapshots.read(spark, tables.tickers, TICKERS)
    names = snapshots.read(spark, tables.names, NAMES)
    foreign = rows.filter("bucket = 'review_foreign'")
    done = pr.promote(
        rows.filter("bucket = 'confirmed'"), foreign, stoplist=words, tickers=tickers, names=names
    )
    metrics = pr.verification(tickers, done)
    if dry_run:
        return metrics
    metrics = materialize(metrics, "verification")
    kept, _ = pr.split_foreign(foreign, words)
    files.write_rows(done.dropped, f"{out}/foreign_dropped")
    files.write_rows(kept, f"{out}/foreign_kept")
    stop_rows = rows.filter("bucket = 'stoplist'")
    files.write_rows(pr.merge_stoplist(stop_rows, done.dropped), f"{out}/stoplist")
    snapshots.write(tickers.unionByName(done.new_tickers), tables.tickers)
    snapshots.write(names.unionByName(done.new_names), tables.names)
    return metrics


def capture_report(
    spark: SparkSession, stats: str, comments: str, day: str
) -> tuple[DataFrame, DataFrame]:
    """Hours of a UTC day, and the day's summary with its verdict."""
    hours = capture.hourly_report(spark.read.parquet(stats), spark.read.parquet(comments), day)
    return hours, capture.day_summary(hours).withColumn("verdict", capture.verdict())
