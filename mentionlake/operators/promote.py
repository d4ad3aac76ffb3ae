"""Promotion of classified candidates into the ticker and name tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.operators import classify as cl
from mentionlake.operators.keyed_write import first_wins
from mentionlake.operators.universe import new_corpus_names, new_corpus_tickers
from mentionlake.session import materialize



def _order() -> list:
    return ["source_rank", F.desc("cashtag_count"), "symbol"]


def split_foreign(foreign: DataFrame, stoplist: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) foreign-suffix candidates; dropped rows are rewritten as stoplist rows."""
    judged = cl.filter_foreign(foreign, stoplist)
    kept = judged.filter("drop_reason IS NULL").drop("drop_reason")
    dropped = judged.filter("drop_reason IS NOT NULL").withColumns(
        {
            "bucket": F.lit("stoplist"),
            "reason": F.concat(F.lit("foreign_suffix_false_positive:"), "drop_reason"),
            "sources": F.lit("foreign_suffix_filter"),
            "matched_names": F.lit(""),
            "action": F.lit("ignore"),
        }
    )
    return kept, dropped.drop("drop_reason")


def to_listings(candidates: DataFrame) -> DataFrame:
    """Candidates as listings: first matched name or a made-up one, exchange from the reason."""
    first_name = F.trim(F.split_part(F.coalesce("matched_names", F.lit("")), F.lit("|"), F.lit(1)))
    reason = F.coalesce("reason", F.lit(""))
    made_up = F.concat(
        F.lit("Corpus-mined ("), F.coalesce(F.nullif(reason, F.lit("")), F.lit("corpus")), F.lit(")")
    )
    exchange = (
        F.when(reason.contains("bankruptcy_Q"), "OTC-BANKRUPTCY")
        .when(reason.contains("suffix_adr_Y") | reason.contains("suffix_foreign_F"), "OTC-FOREIGN")
        .otherwise("CORPUS")
    )
    return candidates.select(
        F.upper(F.trim("symbol")).alias("symbol"),
        F.coalesce(F.nullif(first_name, F.lit("")), made_up).alias("name"),
        exchange.alias("exchange"),
        F.lit(False).alias("is_etf"),
        "source_rank",
        "cashtag_count",
    )


@dataclass(frozen=True)
class Promotion:
    listings: DataFrame
    new_tickers: DataFrame
    new_names: DataFrame
    dropped: DataFrame


def promote(
    confirmed: DataFrame,
    foreign: DataFrame,
    *,
    stoplist: DataFrame,
    tickers: DataFrame,
    names: DataFrame,
) -> Promotion:
    """Rows a promotion would insert. No table is changed, so this is also the dry run.

    A symbol that is both confirmed and foreign counts as confirmed. Listings and dropped rows are
    staged, as everything that follows starts from them.
    """
    kept, dropped = split_foreign(foreign, stoplist)
    rows = confirmed.withColumn("source_rank", F.lit(0)).unionByName(
        kept.withColumn("source_rank", F.lit(1))
    )
    first = first_wins(rows.withColumn("symbol", F.upper("symbol")), ["symbol"], _order())
    listings = materialize(to_listings(first), "promoted")
    return Promotion(
        listings=listings,
        new_tickers=new_corpus_tickers(tickers, listings, _order()),
        new_names=new_corpus_names(names, listings, _order()),
        dropped=materialize(dropped, "dropped"),
    )


def verification(tickers_before: DataFrame, promotion: Promotion) -> DataFrame:
    """Metrics (metric, item, n): tickers per source before and after, promoted symbols present,
    and dropped symbols that are corpus-mined all the same (should be 0)."""
    columns = ["symbol", "ticker_source"]
    after = tickers_before.select(*columns, F.lit(1).alias("old")).unionByName(
        promotion.new_tickers.select(*columns, F.lit(0).alias("old"))
    )
    promoted = promotion.listings.select("symbol", F.lit(True).alias("promoted"))
    dropped = promotion.dropped.select("symbol", F.lit(True).alias("dropped")).distinct()
    flagged = after.join(promoted, "symbol", "left").join(dropped, "symbol", "left")
    mined = F.col("ticker_source") == "corpus_mined"
    counted = flagged.rollup("ticker_source").agg(
        F.grouping("ticker_source").alias("is_total"),
        F.sum("old").alias("before"),
        F.count(F.lit(1)).alias("after"),
        F.count_if("promoted").alias("present"),
        F.count_if(F.col("dropped") & mined).alias("wrong"),
    )

    def metric(name: str, item: Column, n: str) -> Column:
        return F.struct(F.lit(name).alias("metric"), item.alias("item"), F.col(n).alias("n"))

    source, none = F.col("ticker_source"), F.lit("")
    metrics = F.when(
        F.col("is_total") == 0,
        F.array(metric("before", source, "before"), metric("after", source, "after")),
    ).otherwise(
        F.array(metric("present", none, "present"), metric("dropped_but_mined", none, "wrong"))
    )
    listed = promotion.listings.agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.select(F.inline(metrics))
        .filter("n > 0 OR item = ''")
        .unionByName(listed.select(F.lit("promoted").alias("metric"), none.alias("item"), "n"))
    )


def merge_stoplist(stop_rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Stoplist rows with the dropped ones merged in by symbol, the later row winning.

    ``is_new`` marks symbols the stoplist did not have.
    """
    both = stop_rows.withColumn("_load", F.lit(0)).unionByName(
        dropped.withColumn("_load", F.lit(1))
    )
    known = stop_rows.select("symbol").distinct().withColumn("_known", F.lit(True))
    last = first_wins(both, ["symbol"], [F.desc("_load"), F.desc("cashtag_count"), "reason"])
    return (
        last.drop("_load")
        .join(known, "symbol", "left")
        .withColumn("is_new", F.col("_known").isNull())
        .drop("_known")
        .orderBy(F.desc("cashtag_count"), "symbol")
    )
