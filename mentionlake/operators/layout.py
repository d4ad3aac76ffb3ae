"""Table layout: date partitions, clustered files, compaction and occupancy."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionlake import fixed_values as fixed

PARTITION = "created_date"
MOST_STRETCHES = 50  # of days that a filter names by their ends


def with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn(PARTITION, F.to_date("created_utc"))


def created_between(
    rows: DataFrame, low: Column | None = None, high: Column | None = None
) -> DataFrame:
    """Rows created within both bounds. A date-partitioned table is told the dates as well: a
    predicate on the timestamp alone would not prune its folders."""
    for bound, test in ((low, "__ge__"), (high, "__le__")):
        if bound is None:
            continue
        rows = rows.filter(getattr(F.col("created_utc"), test)(bound))
        if PARTITION in rows.columns:
            rows = rows.filter(getattr(F.col(PARTITION), test)(F.to_date(bound)))
    return rows


def on_days(days: Iterable[date]) -> Column:
    """Whether a row's date is one of ``days``, as literals. Stretches of days are named by their ends, so a
    filter on all dates of a large table is as short as one on a few."""
    ends: list[list[date]] = []
    for day in sorted(set(days)):
        if ends and day - ends[-1][1] == timedelta(1):
            ends[-1][1] = day
        else:
            ends.append([day, day])
    if not ends:
        return F.lit(False)
    if len(ends) <= MOST_STRETCHES:
        return F.expr(" OR ".join(f"{PARTITION} BETWEEN DATE'{a}' AND DATE'{b}'" for a, b in ends))
    return F.expr(f"{PARTITION} IN ({', '.join(f"DATE'{day}'" for day in sorted(set(days)))})")


def _clustered(rows: DataFrame) -> DataFrame:
    """Rows brought together by date, split again where a date is large, sorted for skipping."""
    return rows.hint("rebalance", PARTITION).sortWithinPartitions(
        PARTITION, "subreddit", F.desc("created_utc")
    )


def append_rows(rows: DataFrame, table: str) -> None:
    """Append to a date-partitioned raw table. Rebalancing sizes files by the advisory size, so a
    date that holds a third of the rows is written by many tasks."""
    dated = rows if PARTITION in rows.columns else with_date(rows)
    _clustered(dated).write.mode("append").option("compression", "zstd").partitionBy(
        PARTITION
    ).parquet(table)


def overwrite_dates(rows: DataFrame, table: str) -> None:
    """Replace the dates that ``rows`` has, and only those. ``rows`` must not be read from ``table``:
    stage them first, so that a failed write can be repeated."""
    writer = _clustered(rows).write.mode("overwrite").option("compression", "zstd")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table)


def files_by_date(table_rows: DataFrame) -> DataFrame:
    """(created_date, rows, files, bytes) from file metadata; no data column is read."""
    meta = table_rows.select(PARTITION, "_metadata.file_path", "_metadata.file_size")
    per_file = meta.groupBy(PARTITION, "file_path").agg(
        F.count(F.lit(1)).alias("rows"), F.first("file_size").alias("bytes")
    )
    return per_file.groupBy(PARTITION).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def due_for_compaction(table_rows: DataFrame, today: Column) -> DataFrame:
    """Dates older than the compression age that lie in several files, largest first."""
    limit = F.date_sub(today, fixed.COMPRESS_AFTER_DAYS)
    return files_by_date(table_rows.filter(F.col(PARTITION) < limit)).filter("files > 1").orderBy(
        F.desc("bytes"), PARTITION
    )


def compact(table_rows: DataFrame, today: Column, target: str) -> list:
    """Rewrite the dates that are due into ``target``, a new version folder, and return them.

    Young dates and old ones that are a single file stay where they are; ``compacted_parts`` gives all.
    """
    days = [row[0] for row in due_for_compaction(table_rows, today).select(PARTITION).toLocalIterator()]
    if days:
        append_rows(table_rows.filter(F.col(PARTITION).isin(days)), target)
    return days


def compacted_parts(table_rows: DataFrame, days: list, target: str) -> list[DataFrame]:
    """The dates of the table that stayed and the rewritten ones; their union is the table."""
    if not days:
        return [table_rows]
    return [table_rows.filter(~F.col(PARTITION).isin(days)), table_rows.sparkSession.read.parquet(target)]


def occupancy(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, bytes, and days between its first and last date with and without rows."""
    out = None
    for name, rows in tables.items():
        days = files_by_date(rows)
        ends = days.agg(F.min(PARTITION).alias("lo"), F.max(PARTITION).alias("hi"))
        every = ends.select(
            F.explode(F.sequence("lo", "hi", F.make_dt_interval(days=F.lit(1)))).alias(PARTITION)
        )
        one = (
            every.join(days, PARTITION, "left")
            .agg(
                F.sum("rows").alias("rows"),
                F.sum("bytes").alias("bytes"),
                F.count_if(F.col("rows").isNull()).alias("empty_days"),
                F.count_if(F.col("rows").isNotNull()).alias("nonempty_days"),
            )
            .select(F.lit(name).alias("table_name"), "*")
        )
        out = one if out is None else out.unionByName(one)
    return out
