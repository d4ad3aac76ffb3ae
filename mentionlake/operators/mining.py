"""Counting cashtags and all-caps words over the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import text as tx
from mentionlake.operators.layout import created_between


def since(df: DataFrame, start_date: str) -> DataFrame:
    """Rows created on or after a UTC date."""
    return created_between(df, F.to_timestamp(F.lit(f"{start_date} 00:00:00")))


def tagged_tokens(texts: DataFrame) -> DataFrame:
    """One row per token of ``text``: (symbol, is_cashtag). ``$GME`` yields one of each kind."""

    def tag(tokens, is_cashtag):
        return F.transform(
            tokens, lambda t: F.struct(t.alias("symbol"), F.lit(is_cashtag).alias("is_cashtag"))
        )

    pairs = F.concat(tag(tx.cashtags(F.col("text")), True), tag(tx.all_caps(F.col("text")), False))
    return texts.select(F.inline(pairs))


def token_counts(comments: DataFrame, posts: DataFrame, start_date: str) -> DataFrame:
    """(symbol, cashtag_count, allcaps_count) over both tables.

    Each table is scanned once; the counts are combined on the map side, so the shuffle carries one
    row per symbol and task however often a symbol is mentioned.
    """
    bodies = since(comments, start_date).filter(tx.has_body(F.col("body")))
    texts = bodies.select(F.col("body").alias("text")).unionByName(
        since(posts, start_date).select(
            tx.post_text(F.col("title"), F.col("selftext")).alias("text")
        )
    )
    return (
        tagged_tokens(texts)
        .groupBy("symbol")
        .agg(
            F.count_if("is_cashtag").alias("cashtag_count"),
            F.count_if(~F.col("is_cashtag")).alias("allcaps_count"),
        )
    )


def mine_tokens(
    comments: DataFrame,
    posts: DataFrame,
    tickers: DataFrame,
    *,
    min_count: int = fixed.MIN_TOKEN_COUNT,
    start_date: str = fixed.MINE_START_DATE,
) -> DataFrame:
    """Review rows for frequent tokens that are not known tickers, most frequent first."""
    total = F.col("cashtag_count") + F.col("allcaps_count")
    evidence = (
        F.when((F.col("cashtag_count") > 0) & (F.col("allcaps_count") > 0), "cashtag+allcaps")
        .when(F.col("cashtag_count") > 0, "cashtag")
        .otherwise("allcaps")
    )
    return (
        token_counts(comments, posts, start_date)
        .filter((total >= min_count) & F.col("symbol").rlike(fixed.SYMBOL_SHAPE))
        .join(tickers.select("symbol"), "symbol", "left_anti")
        .select(
            "symbol",
            "cashtag_count",
            "allcaps_count",
            total.alias("total_count"),
            evidence.alias("evidence"),
            F.lit("review").alias("action"),
        )
        .orderBy(F.desc("total_count"), "symbol")
    )
