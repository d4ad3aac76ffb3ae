"""Reference lists for candidate classification.

Equity lists come back in long form, one row per (symbol, source, name, exchange); see
``operators.hits`` for the per-symbol view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.sources import listings, longzstd

HIT_COLUMNS = ("symbol", "source", "name", "exchange")


def read_sec_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON object of {ticker, title} objects."""
    doc = spark.read.text(path, wholetext=True)
    row = F.explode(F.map_values(F.from_json("value", "map<string, struct<ticker:string,title:string>>")))
    symbol = F.upper(F.trim(F.coalesce("row.ticker", F.lit(""))))
    return doc.select(row.alias("row")).select(
        symbol.alias("symbol"),
        F.lit("sec_company_tickers").alias("source"),
        F.col("row.title").alias("name"),
        F.lit(None).cast("string").alias("exchange"),
    ).filter("symbol <> ''")


def read_sec_exchange(spark: SparkSession, path: str) -> DataFrame:
    """JSON object with ``fields`` (column names) and ``data`` (rows)."""
    doc = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "fields array<string>, data array<array<string>>").alias("doc")
    )
    rows = doc.select("doc.fields", F.explode("doc.data").alias("row"))

    def cell(name: str):
        return F.element_at("row", F.array_position("fields", name).cast("int"))

    exchange = cell("exchange")
    return rows.select(
        F.upper(F.trim(cell("ticker"))).alias("symbol"),
        F.concat(F.lit("sec_exchange:"), F.coalesce(exchange, F.lit("None"))).alias("source"),
        cell("name").alias("name"),
        exchange.alias("exchange"),
    ).filter("symbol <> ''")


def read_historical(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly snapshots of both directories: files, or folders of files, named ``wayback_<year>_<kind>``.

    Each file is read by its own header; files that are no directory are left out, see
    ``listings.unreadable``. A kind without files has no rows.
    """
    found = longzstd.archive_files(folder)
    kinds = {"nasdaqlisted": listings.read_nasdaq_listed, "otherlisted": listings.read_other_listed}
    out = spark.createDataFrame([], "symbol string, source string, name string, exchange string")
    for kind, read in kinds.items():
        name = rf"(wayback_[^/]*_{kind})"
        files = [f for f in found if re.search(name, f)]
        if files:
            rows = read(spark, files, lenient=True)
            out = out.unionByName(rows.select("symbol", F.regexp_extract("file", name, 1).alias("source"), "name", "exchange"))
    return out


def read_coins(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of {symbol, name}: alphanumeric symbols of at most five characters."""
    rows = spark.read.schema("symbol string, name string").json(path, multiLine=True)
    return rows.select(
        F.upper(F.trim("symbol")).alias("symbol"), F.trim(F.coalesce("name", F.lit(""))).alias("name")
    ).filter(F.col("symbol").rlike(r"^[\p{L}\p{N}]{1,5}$"))


def read_stoplist(spark: SparkSession, path: str) -> DataFrame:
    """Slang stoplist: a text file with one symbol per line, ``#`` starts a comment."""
    word = F.upper(F.trim(F.regexp_replace("value", "#.*$", "")))
    return spark.read.text(path).select(word.alias("symbol")).filter("symbol <> ''").distinct()
