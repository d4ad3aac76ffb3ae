"""Capture report: comment volume, snapshots and truncated polls per hour and per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import times
from mentionlake.operators.layout import created_between


def comments_per_thread(comments: DataFrame) -> DataFrame:
    return comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_comments"))


def poll_stats(polls: DataFrame, comments: DataFrame) -> DataFrame:
    """Poll results with the number of comments the table holds for each polled thread."""
    counts = comments_per_thread(comments).withColumnRenamed("post_id", "thread_id")
    held = F.coalesce("n_comments", F.lit(0)).cast("int").alias("comments_in_db_for_thread")
    return polls.join(counts, "thread_id", "left").select(
        "event_id",
        "thread_id",
        "polled_at",
        "num_comments_reported",
        held,
        "fetched_this_cycle",
        "was_truncated",
    )


def append_stats(stats: DataFrame, table: str, run: str) -> None:
    """Add a run's rows to the poll statistics, one folder per run and UTC day.

    ``run`` names what produced the rows (a job run, a micro-batch): the same run written again replaces
    its rows, so a repeated run adds none.
    """
    dated = stats.withColumn("polled_date", F.to_date("polled_at"))
    dated.hint("rebalance", "polled_date").write.mode("overwrite").partitionBy("polled_date").parquet(f"{table}/run={run}")


def hourly_report(capture: DataFrame, comments: DataFrame, day: str | None = None) -> DataFrame:
    """One row per hour that has comments, snapshots or truncations; all days, or one UTC day.

    Comments count only for threads polled on the same day, so a day without polls has no rows.
    Everything is reduced to (hour, thread) before it meets anything else.
    """
    if day:
        capture = capture.filter(times.within_day(F.col("polled_at"), day))
        if "polled_date" in capture.columns:
            capture = capture.filter(F.col("polled_date") == F.lit(day).cast("date"))
        start = F.to_timestamp(F.lit(f"{day} 00:00:00"))
        in_reach = created_between(comments, start, start + F.make_dt_interval(days=F.lit(1)))
        comments = in_reach.filter(times.within_day(F.col("created_utc"), day))
    polls = (
        capture.groupBy(F.date_trunc("hour", "polled_at").alias("hour"), "thread_id")
        .agg(
            F.max_by(
                F.struct("comments_in_db_for_thread", "num_comments_reported"),
                F.struct("polled_at", "event_id"),
            ).alias("last"),
            F.count_if("was_truncated").alias("truncations"),
        )
    )
    polled = polls.select(F.to_date("hour").alias("day"), F.col("thread_id").alias("post_id")).distinct()
    volume = (
        comments.groupBy(F.date_trunc("hour", "created_utc").alias("hour"), "post_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("day", F.to_date("hour"))
        .join(polled, ["day", "post_id"], "left_semi")
    )
    zero = F.lit(0).cast("bigint")
    parts = polls.select(
        "hour",
        zero.alias("comment_volume"),
        F.col("last.comments_in_db_for_thread").cast("bigint").alias("comments_in_db"),
        F.col("last.num_comments_reported").cast("bigint").alias("num_comments_reported"),
        "truncations",
    ).unionByName(
        volume.select(
            "hour",
            F.col("n").alias("comment_volume"),
            zero.alias("comments_in_db"),
            zero.alias("num_comments_reported"),
            zero.alias("truncations"),
        )
    )
    sums = ["comment_volume", "comments_in_db", "num_comments_reported", "truncations"]
    hours = parts.groupBy("hour").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    rate = F.when(
        F.col("num_comments_reported") > 0,
        F.col("comments_in_db") / F.col("num_comments_reported") * 100,
    )
    return hours.select(
        "hour",
        "comment_volume",
        "comments_in_db",
        "num_comments_reported",
        rate.alias("capture_rate_pct"),
        "truncations",
        times.in_market_hours(F.col("hour")).alias("market_open"),
    ).orderBy("hour")


def day_summary(hours: DataFrame) -> DataFrame:
    """Totals per day; the mean capture rate is the unweighted mean of the hourly rates."""
    open_truncations = F.when(F.col("market_open"), F.col("truncations")).otherwise(0)
    return hours.groupBy(F.to_date("hour").alias("day")).agg(
        F.sum("comment_volume").alias("total_volume"),
        F.sum("truncations").alias("total_truncations"),
        F.sum(open_truncations).alias("market_open_truncations"),
        F.count_if(F.col("market_open") & (F.col("truncations") > 0)).alias(
            "market_open_hours_with_truncations"
        ),
        F.avg("capture_rate_pct").alias("avg_capture_pct"),
        F.min("capture_rate_pct").alias("min_capture_pct"),
    )


def verdict() -> Column:
    """Reading of a day summary; truncations decide, the capture rate is context only."""
    total, opened = F.col("total_truncations"), F.col("market_open_truncations")
    return (
        F.when(total == 0, fixed.VERDICT_ZERO)
        .when(opened == 0, F.format_string(fixed.VERDICT_OFF_HOURS, total))
        .when(
            (F.col("market_open_hours_with_truncations") >= 2) | (opened >= 3),
            fixed.VERDICT_REPEATED,
        )
        .otherwise(fixed.VERDICT_ISOLATED)
    )
