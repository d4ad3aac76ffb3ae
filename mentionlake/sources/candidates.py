"""Candidate CSV files exchanged between the mining, review and promotion steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEW_SCHEMA = (
    "symbol string, cashtag_count bigint, allcaps_count bigint, total_count bigint, "
    "evidence string, action string"
)
CLASSIFIED_SCHEMA = (
    "symbol string, cashtag_count bigint, allcaps_count bigint, total_count bigint, "
    "evidence string, reason string, sources string, matched_names string, action string"
)


def write_rows(rows: DataFrame, path: str) -> None:
    """Kept or dropped candidates as one CSV folder."""
    rows.write.csv(path, header=True)


def write_review(candidates: DataFrame, path: str) -> None:
    candidates.write.csv(path, header=True)


def read_review(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW_SCHEMA).csv(path, header=True)


def write_buckets(classified: DataFrame, path: str) -> None:
    """One folder per bucket, most-tagged candidates first.

    Range-partitioned on the whole order, so a bucket with most of the rows is still written by
    many tasks.
    """
    order = ["bucket", classified["cashtag_count"].desc(), "symbol"]
    ordered = classified.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.partitionBy("bucket").csv(path, header=True)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{CLASSIFIED_SCHEMA}, bucket string"
    # an absent list is written as an empty cell and has to come back as empty text
    return spark.read.schema(schema).csv(path, header=True).fillna("", ["sources", "matched_names"])
