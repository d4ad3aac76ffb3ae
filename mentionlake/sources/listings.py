"""Exchange symbol directories: pipe-delimited, latin-1, with a header and a footer line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import text as tx

ORDER = ("file", "block", "line")


NEEDED = ("Security Name", "ETF", "Test Issue")


def _width(spark: SparkSession, path: str | list[str], glob: str | None) -> int:
    """Cells of the longest line."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path)
    bars = F.length("value") - F.length(F.replace("value", F.lit("|"), F.lit("")))
    return (lines.agg(F.max(bars)).first()[0] or 0) + 1


def _cells(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    """Lines as arrays of cells, with the first line of their file beside them."""
    columns = [f"c{i}" for i in range(_width(spark, path, glob))]
    reader = spark.read.schema(", ".join(f"{c} string" for c in columns)).option("maxColumns", len(columns) + 1)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.csv(path, sep="|", header=False, encoding="ISO-8859-1", quote='"', escape='"').select(
        F.array(*(F.trim(F.coalesce(c, F.lit(""))) for c in columns)).alias("cells"),
        tx.plain_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    first = F.min_by(F.struct(F.col("cells").alias("header"), F.col("block").alias("b"), F.col("line").alias("l")), F.struct("block", "line"))
    heads = rows.groupBy("file").agg(first.alias("head"))
    return rows.join(heads, "file").select(
        "cells", *ORDER, "head.header", (F.col("block").eqNullSafe(F.col("head.b")) & (F.col("line") == F.col("head.l"))).alias("is_head"))


def _directory(
    spark: SparkSession, path: str | list[str], symbol: str, glob: str | None = None, lenient: bool = False,
) -> DataFrame:
    """Rows of directory files, each read by its own header.

    A file whose header lacks a column is no directory: reading one fails, or, if ``lenient``, it is
    left out (``unreadable`` lists such files).
    """
    rows = _cells(spark, path, glob)
    complete = F.lit(True)
    for name in (symbol, *NEEDED):
        complete = complete & F.array_contains("header", name)
    if lenient:
        rows = rows.filter(complete)
    else:
        problem = F.concat(F.lit("not a symbol directory: "), F.col("file"))
        rows = rows.filter(F.when(complete, True).otherwise(F.raise_error(problem).cast("boolean")))

    def cell(name: str) -> Column:
        at = F.array_position("header", name)
        return F.when(at > 0, F.element_at("cells", F.greatest(at, F.lit(1)).cast("int"))).otherwise("")

    # the footer is one cell in the first column
    footer = F.upper(F.col("cells")[0]).startswith(fixed.LISTING_FOOTER)
    return rows.filter(~F.col("is_head") & ~footer).select(
        F.upper(cell(symbol)).alias("symbol"),
        cell("Security Name").alias("name"),
        cell("Exchange").alias("exchange_code"),
        (F.upper(cell("ETF")) == "Y").alias("is_etf"),
        (F.upper(cell("Test Issue")) == "Y").alias("is_test"),
        *ORDER,
    ).filter("NOT is_test AND symbol <> '' AND name <> ''").drop("is_test")


def unreadable(spark: SparkSession, path: str, symbol: str, glob: str) -> DataFrame:
    """(file) of files that a lenient read leaves out."""
    lacks = F.lit(False)
    for name in (symbol, *NEEDED):
        lacks = lacks | ~F.array_contains("header", name)
    return _cells(spark, path, glob).filter(lacks).select("file").distinct()


def read_nasdaq_listed(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    rows = _directory(spark, path, "Symbol", **options)
    return rows.withColumn("exchange", F.lit("NASDAQ")).drop("exchange_code")


def read_other_listed(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    rows = _directory(spark, path, "ACT Symbol", **options)
    return rows.withColumn("exchange", tx.exchange_name(F.col("exchange_code"))).drop("exchange_code")
