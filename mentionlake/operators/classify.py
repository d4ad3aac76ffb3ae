"""Classification of mined candidates into buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import text as tx
from mentionlake.operators.hits import joined_names, joined_sources

COLUMNS = (
    "symbol",
    "cashtag_count",
    "allcaps_count",
    "total_count",
    "evidence",
    "bucket",
    "reason",
    "sources",
    "matched_names",
    "action",
)


def flag_stoplist(rows: DataFrame, stoplist: DataFrame) -> DataFrame:
    """Adds ``stopped`` (symbol on the stoplist), ``base`` and ``base_stopped``."""
    words = stoplist.select(F.upper("symbol").alias("symbol")).distinct()
    on_symbol = words.withColumn("stopped", F.lit(True))
    on_base = words.select(F.col("symbol").alias("base"), F.lit(True).alias("base_stopped"))
    return (
        rows.withColumn("base", tx.foreign_base(F.col("symbol")))
        .join(on_symbol, "symbol", "left")
        .join(on_base, "base", "left")
        .fillna(False, ["stopped", "base_stopped"])
    )


def foreign_drop_reason() -> Column:
    """Why a foreign-looking symbol is a false positive, else NULL. Needs ``flag_stoplist``.

    A stoplisted base does not count against an F symbol that is tagged often enough to look like a
    ticker.
    """
    symbol, base = F.col("symbol"), F.col("base")
    cash, caps = F.col("cashtag_count"), F.col("allcaps_count")
    common_base = F.col("base_stopped") | base.isin(*fixed.FOREIGN_FALSE_BASES)
    tagged_like_ticker = (cash > 0) & (caps <= 10 * cash)
    shouted = (cash > 0) & (caps > 10 * cash)
    return (
        F.when(F.col("stopped"), "symbol_in_stoplist")
        .when(
            common_base & ~(symbol.endswith("F") & tagged_like_ticker),
            F.concat(F.lit("base_in_slang_or_common:"), base),
        )
        .when(
            shouted & (common_base | symbol.isin(*fixed.FOREIGN_FALSE_BASES)),
            "high_allcaps_and_slang",
        )
    )


def is_otc_or_foreign(sources: Column, exchanges: Column) -> Column:
    by_tag = F.exists(sources, lambda s: s.rlike("^sec_exchange:(OTC|None)") | s.endswith(":OTC"))
    by_exchange = F.exists(exchanges, lambda e: F.upper(e).isin(*fixed.OTC_EXCHANGES))
    return F.when(F.size(exchanges) == 0, by_tag).otherwise(by_exchange)


def _outcome(
    bucket: str | Column,
    reason: str | Column,
    sources: str | Column = "",
    names: str | Column = "",
    action: str = "review",
) -> Column:
    def value(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(
        value(bucket).alias("bucket"),
        value(reason).alias("reason"),
        value(sources).alias("sources"),
        value(names).alias("matched_names"),
        F.lit(action).alias("action"),
    )


def filing_hits(filings: DataFrame) -> DataFrame:
    """One row per symbol: whether any filing has it, and the label of one that does."""
    rows = filings.select(F.upper(F.trim("symbol")).alias("symbol"), F.coalesce("hit", F.lit(False)).alias("hit"), "label")
    return rows.groupBy("symbol").agg(
        F.max("hit").alias("filed"), F.max_by("label", F.struct("hit", "label")).alias("label"))


def classify(
    candidates: DataFrame,
    *,
    equity: DataFrame,
    sec: DataFrame,
    coins: DataFrame,
    stoplist: DataFrame,
    filings: DataFrame,
    min_cashtag: int = fixed.MIN_CASHTAG,
) -> DataFrame:
    """Candidates with bucket, reason, sources, matched names and action.

    ``equity`` and ``sec`` are ``symbol_hits`` frames, ``coins`` is (symbol, names), ``stoplist`` is
    (symbol), ``filings`` is (symbol, hit, label). The first rule that applies decides.
    """
    upper = F.upper(F.trim("symbol"))
    rows = candidates.filter(F.col("cashtag_count") >= min_cashtag).withColumn("symbol", upper)
    rows = (
        flag_stoplist(rows, stoplist)
        .join(
            equity.select("symbol", F.col("sources").alias("eq_sources"), F.col("names").alias("eq_names")),
            "symbol",
            "left",
        )
        .join(
            sec.select(
                "symbol",
                F.col("sources").alias("sec_sources"),
                F.col("names").alias("sec_names"),
                "exchanges",
            ),
            "symbol",
            "left",
        )
        .join(coins.select("symbol", F.col("names").alias("coin_names")), "symbol", "left")
        .join(filing_hits(filings), "symbol", "left")
    )
    symbol = F.col("symbol")
    equity_sources, equity_names = joined_sources(F.col("eq_sources")), joined_names(F.col("eq_names"))
    foreign = tx.foreign_reason(symbol)
    false_positive = foreign_drop_reason()
    alias = tx.lookup(fixed.KNOWN_ALIASES, symbol)
    confirmed = "confirmed"
    outcome = (
        # listed on a national exchange or known to the regulator
        F.when(
            (F.size("eq_sources") > 0) & (F.col("stopped") | (F.length(symbol) <= 1)),
            _outcome("ambiguous", "equity_listing_match", equity_sources, equity_names),
        )
        .when(
            F.size("eq_sources") > 0,
            _outcome(confirmed, "equity_listing_match", equity_sources, equity_names),
        )
        # not listed anywhere
        .when(F.col("stopped"), _outcome("stoplist", "slang_or_profanity", "slang_stoplist"))
        .when(
            F.coalesce(is_otc_or_foreign(F.col("sec_sources"), F.col("exchanges")), F.lit(False)),
            _outcome(
                confirmed,
                "sec_otc_or_foreign_exchange",
                joined_sources(F.col("sec_sources")),
                joined_names(F.col("sec_names")),
            ),
        )
        .when(
            tx.is_foreign_suffix(symbol) & false_positive.isNotNull(),
            _outcome(
                "stoplist",
                F.concat(F.lit("foreign_suffix_false_positive:"), false_positive),
                "foreign_suffix_filter",
                action="ignore",
            ),
        )
        .when(tx.is_foreign_suffix(symbol), _outcome("review_foreign", foreign, foreign))
        .when(
            F.size("coin_names") > 0,
            _outcome("crypto", "coingecko_symbol", "coingecko", joined_names(F.col("coin_names"))),
        )
        # refinement of what is left for review
        .when(
            symbol.isin(*fixed.CONFIDENT_EQUITY),
            _outcome(confirmed, "human_confident_equity", "manual_review_allowlist"),
        )
        .when(
            alias.isNotNull(),
            _outcome("alias", F.concat(F.lit("alias_of:"), alias), "known_alias_map", alias),
        )
        .when(
            F.col("filed"),
            _outcome(confirmed, "sec_edgar_fulltext", "sec_efts", F.coalesce("label", F.lit(""))),
        )
        .when(
            F.col("cashtag_count") >= fixed.SPOTCHECK_CASHTAG,
            _outcome(confirmed, "high_cashtag_spotcheck", "cashtag_threshold_200"),
        )
        .otherwise(_outcome("unrecognized", "unmatched_low_cashtag", action="ignore_or_manual"))
    )
    decided = rows.withColumn("_o", outcome)
    counted = ["symbol", "cashtag_count", "allcaps_count", "total_count", "evidence"]
    return decided.select(*counted, "_o.*").orderBy("bucket", F.desc("cashtag_count"), "symbol")


def bucket_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def filter_foreign(rows: DataFrame, stoplist: DataFrame) -> DataFrame:
    """Adds ``drop_reason`` to foreign-suffix rows; NULL means the row is kept."""
    flagged = flag_stoplist(rows, stoplist).withColumn("drop_reason", foreign_drop_reason())
    return flagged.drop("stopped", "base", "base_stopped")
