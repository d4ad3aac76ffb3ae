"""Hourly ingest rates with alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake import fixed_values as fixed


def counters() -> list[Column]:
    """Counters over an ingest log with ``kind`` (posts, comments, requests) and ``n``."""

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    return [
        total("posts").alias("posts_per_hour"),
        total("comments").alias("comments_per_hour"),
        total("requests").alias("api_requests"),
    ]


def with_alerts(hours: DataFrame) -> DataFrame:
    per_minute = F.col("api_requests") / 60
    return hours.select(
        "hour",
        "posts_per_hour",
        "comments_per_hour",
        "api_requests",
        per_minute.alias("requests_per_minute"),
        (per_minute > fixed.REQUESTS_PER_MINUTE_ALERT).alias("rate_alert"),
        ((F.col("posts_per_hour") == 0) & (F.col("comments_per_hour") == 0)).alias("idle_alert"),
    )


def heartbeat(log: DataFrame) -> DataFrame:
    """One row per hour from the first to the last log entry, hours without entries included."""
    hours = log.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(*counters())
    ends = hours.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    step = F.make_dt_interval(hours=F.lit(1))
    spine = ends.select(F.explode(F.sequence("lo", "hi", step)).alias("hour"))
    return with_alerts(spine.join(hours, "hour", "left").fillna(0))
