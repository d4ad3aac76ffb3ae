"""Per-symbol view of the reference lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

NAMES_SHOWN = 5


def all_hits(*lists: DataFrame) -> DataFrame:
    """Rows of several lists one after the other, with trimmed names."""
    rows = lists[0]
    for other in lists[1:]:
        rows = rows.unionByName(other)
    return rows.withColumn("name", F.nullif(F.trim("name"), F.lit("")))


def merge_hits(*lists: DataFrame) -> DataFrame:
    """Set union of several lists in long form: distinct (symbol, source, name, exchange)."""
    return all_hits(*lists).distinct()


def first_names(named: DataFrame, shown: int | None = NAMES_SHOWN) -> DataFrame:
    """(symbol, names): the names of each symbol in text order, for display only the first ones.

    Ranked and cut before they are collected, so a symbol with very many names stays one short row.
    """
    w = Window.partitionBy("symbol").orderBy("name")
    names = named.select("symbol", "name").filter(F.col("name").isNotNull()).distinct()
    if shown is not None:
        names = names.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= shown)
    return (
        names.groupBy("symbol")
        .agg(F.array_sort(F.collect_list("name")).alias("names"))
    )


def symbol_hits(hits: DataFrame, shown: int | None = NAMES_SHOWN) -> DataFrame:
    """(symbol, sources, exchanges, names): sets as sorted arrays; names cut to those shown, if any number is.

    Repeated rows do no harm, so ``hits`` may come from ``all_hits``.
    Source tags and exchanges come from short fixed vocabularies, so their sets stay small.
    """
    tags = hits.groupBy("symbol").agg(
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_set("exchange")).alias("exchanges"),
    )
    none = F.array().cast("array<string>")
    return tags.join(first_names(hits, shown), "symbol", "left").withColumn(
        "names", F.coalesce("names", none)
    )


def joined_sources(sources: Column) -> Column:
    return F.array_join(F.array_sort(sources), ";")


def joined_names(names: Column) -> Column:
    return F.array_join(F.slice(F.array_sort(names), 1, NAMES_SHOWN), " | ")
