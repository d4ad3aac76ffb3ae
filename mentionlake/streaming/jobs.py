"""Incremental ingest, and how a stream is run to its end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.operators import archive, capture, quality
from mentionlake.session import new_folder
from mentionlake.sources import longzstd
from mentionlake.streaming import recent


def run_available(stream: DataFrame, label: str, folder: str | None = None) -> str:
    """Process what has arrived, append the output to Parquet files and return where they are.

    ``folder`` keeps output and checkpoint; give the same one again to go on from there.
    """
    folder = folder or new_folder(stream.sparkSession, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{folder}/rows"


def read_output(stream: DataFrame, folder: str) -> DataFrame:
    return stream.sparkSession.read.schema(stream.schema).parquet(folder)


def ingest_lines(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    *,
    kind: str,
    wanted: quality.LoadFilter = quality.LoadFilter(),
    max_files: int = 1000,
    packed: bool = False,
    recent_hours: int | None = None,
    buckets: int | None = None,
) -> None:
    """Load what arrived in a folder of dumps since the last run; safe to repeat after a failure.

    A batch that is run again finds its rows in the table and adds none. ``packed`` reads ``.zst`` files
    with long windows, which may grow by further frames; otherwise new files are read. With
    ``recent_hours`` the keys of rows that young are remembered by the stream, and only older rows are
    looked up in the table (see ``streaming.recent``); a checkpoint keeps the setting it began with.
    """
    if packed:
        lines = longzstd.follow(spark, folder)
    else:
        lines = (
            spark.readStream.option("maxFilesPerTrigger", max_files)
            .text(folder)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
        )

    classified = archive.classify_lines(lines.withColumn("source_rank", F.lit(0)), kind, wanted)
    judged = archive.judged(classified, kind)
    if recent_hours is None:
        def load(batch: DataFrame, number: int) -> None:
            archive.add_rows(archive.staged_rows(archive.numbered(batch)), table, buckets)

        _each_batch(judged, load, checkpoint)
    else:
        marks = recent.Marks(spark, f"{checkpoint}/recent")

        def load_recent(batch: DataFrame, number: int) -> None:
            recent.add_batch(batch, number, table, marks, recent_hours, buckets)

        _each_batch(recent.with_unseen(judged, recent_hours), load_recent, checkpoint)


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def record_stats(stats: DataFrame, table: str, checkpoint: str) -> None:
    """Add a stream of poll results to the statistics. The number of a micro-batch names its rows, so a
    batch that is run again after a failure replaces what it had written."""
    _each_batch(stats, lambda batch, number: capture.append_stats(batch, table, f"batch-{number}"), checkpoint)


def upsert_polled(
    polled: DataFrame, table: str, checkpoint: str, *, mutable: Sequence[str], order: Sequence[str]
) -> None:
    """Apply a stream of polled rows to a raw table, batch by batch. A batch that is run again finds its
    rows in the table with the values it brings, and changes nothing."""
    _each_batch(polled, lambda batch, number: archive.upsert_rows(batch, table, mutable, order), checkpoint)
