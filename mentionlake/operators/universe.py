"""Listed symbols and issuer names: merge of directories, ticker and name tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.functions import text as tx
from mentionlake.operators.keyed_write import first_wins, insert_ignore, replace_by_key

TICKER_COLUMNS = ("symbol", "name", "exchange", "is_etf", "is_active", "ticker_source")
NAME_COLUMNS = ("normalized_name", "symbol")


def merge_listings(groups: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """One row per symbol; an earlier group wins over a later one, file order inside a group."""
    ranked = [g.withColumn("group_rank", F.lit(i)) for i, g in enumerate(groups)]
    rows = ranked[0]
    for group in ranked[1:]:
        rows = rows.unionByName(group)
    return first_wins(rows, ["symbol"], ["group_rank", *order])


def ticker_rows(listings: DataFrame, ticker_source: str) -> DataFrame:
    return listings.withColumns(
        {"is_active": F.lit(True), "ticker_source": F.lit(ticker_source)}
    )


def name_rows(listings: DataFrame) -> DataFrame:
    """Listings with their normalised issuer name; names that normalise to nothing are dropped."""
    named = listings.withColumn("normalized_name", tx.normalize_company_name(F.col("name")))
    return named.filter(F.col("normalized_name") != "")


def upsert_tickers(
    tickers: DataFrame,
    listings: DataFrame,
    order: Sequence[str | Column],
    ticker_source: str = "nasdaq_current",
) -> DataFrame:
    """Reload: every column of a listed symbol is overwritten, symbols not listed stay as they are."""
    rows = ticker_rows(listings, ticker_source)
    return replace_by_key(tickers.select(*TICKER_COLUMNS), rows, ["symbol"], order)


def upsert_ticker_names(
    names: DataFrame, listings: DataFrame, order: Sequence[str | Column]
) -> DataFrame:
    """Names point to the symbol of the newest load; inside a load the first listing keeps a name."""
    return replace_by_key(
        names.select(*NAME_COLUMNS), name_rows(listings), ["normalized_name"], order
    )


def new_corpus_tickers(
    tickers: DataFrame, listings: DataFrame, order: Sequence[str | Column]
) -> DataFrame:
    """Promoted symbols not in the table yet; known symbols are never overwritten."""
    rows = ticker_rows(listings, "corpus_mined")
    return insert_ignore(tickers, rows, ["symbol"], order).select(*TICKER_COLUMNS)


def new_corpus_names(
    names: DataFrame, listings: DataFrame, order: Sequence[str | Column]
) -> DataFrame:
    """Names of promoted symbols that no other symbol holds."""
    return insert_ignore(names, name_rows(listings), ["normalized_name"], order).select(
        *NAME_COLUMNS
    )


def single_word_aliases(symbols: DataFrame, names: DataFrame) -> DataFrame:
    """Symbols spelled like a one-word company name, with the ticker that name belongs to."""
    keyed = symbols.select("symbol", F.lower("symbol").alias("normalized_name"))
    targets = names.select("normalized_name", F.col("symbol").alias("alias_target"))
    return keyed.join(targets, "normalized_name").select("symbol", "alias_target")


def misspellings(symbols: DataFrame, universe: DataFrame) -> DataFrame:
    """Pairs (symbol, near_symbol) exactly one insertion, deletion or substitution apart.

    Equi-joins on deletion neighbourhoods: a substitution pair shares (position, rest), an insertion
    pair shares the shorter symbol. Such a key is met only by true pairs, so nothing is verified
    away and no candidates pile up on a key.
    """
    left = symbols.select("symbol").distinct()
    right = universe.select(F.col("symbol").alias("near_symbol")).distinct()

    def without_one(df: DataFrame, name: str) -> DataFrame:
        s = F.col(name)
        cut = F.transform(
            F.sequence(F.lit(1), F.length(s)),
            lambda i: F.struct(
                i.alias("at"),
                F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))).alias("rest"),
            ),
        )
        return df.filter(F.length(s) > 0).select(name, F.inline(cut))

    left_cuts, right_cuts = without_one(left, "symbol"), without_one(right, "near_symbol")
    substituted = left_cuts.join(right_cuts, ["at", "rest"]).filter("symbol <> near_symbol")
    left_rests = left_cuts.select("symbol", "rest").distinct()
    right_rests = right_cuts.select("near_symbol", "rest").distinct()
    longer = left_rests.join(right, F.col("rest") == F.col("near_symbol"))
    shorter = right_rests.join(left, F.col("rest") == F.col("symbol"))
    pairs = [p.select("symbol", "near_symbol") for p in (substituted, longer, shorter)]
    return pairs[0].unionByName(pairs[1]).unionByName(pairs[2])
