"""Time the headline queries and print one JSON line.

Each query runs once to warm up and is then timed over ``BENCH_RUNS`` runs, of which the best counts.
The whole result is computed and thrown away (``noop`` sink), so nothing is pruned and nothing is
collected.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from mentionlake.plans import QUERIES

HEADLINE = [
    "mine_tokens",
    "load_status_counts",
    "map_comments",
    "map_posts",
    "insert_ignore",
    "upsert_post_mutable",
    "kv_latest",
    "normalize_names",
    "tickers_upsert",
    "alias_edit1",
    "set_union_hits",
    "classify_candidates",
    "foreign_suffix_filter",
    "capture_hourly",
    "capture_day_summary",
    "tree_since_cursor",
    "bounded_fetch",
    "posts_due",
    "truncation_streak",
    "cursor_replay",
    "heartbeat_hourly",
    "layout_write",
    "archive_load",
    "promote",
    "cursor_stream",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return builder.getOrCreate()


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(min(run(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
