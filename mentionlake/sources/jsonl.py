"""Archive lines as rows that remember where they came from.

Columns: source_rank (position of the path in the load), file, block (byte offset of the split),
line (increasing inside a split) and value. Ordering by the first four is file order, without a
shuffle and without giving up splitting of plain files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.functions import text as tx
from mentionlake.sources import longzstd

ORDER = ("source_rank", "file", "block", "line")


def _plain(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text(files).select(
        tx.plain_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def _zstd(spark: SparkSession, files: list[str], spread: int | None) -> DataFrame:
    df = longzstd.scan(spark, files)
    # one frame is one task: hand the lines out before anything is parsed
    return df.repartition(spread, "block", "line") if spread else df


def list_files(paths: Sequence[str]) -> list[tuple[int, str]]:
    """(position of the path, file) for every file behind the paths."""
    return [(rank, f) for rank, path in enumerate(paths) for f in longzstd.archive_files(path)]


def read_files(
    spark: SparkSession, files: Sequence[tuple[int, str]], *, spread: int | None = None
) -> DataFrame:
    """Lines of listed files. Names ending in ``.zst`` are decompressed.

    ``spread`` redistributes decompressed lines over that many partitions.
    """
    groups: dict[tuple[int, bool], list[str]] = {}
    for rank, name in files:
        groups.setdefault((rank, name.endswith(".zst")), []).append(name)
    frames = []
    for (rank, packed), names in groups.items():
        df = _zstd(spark, names, spread) if packed else _plain(spark, names)
        frames.append(df.select(F.lit(rank).alias("source_rank"), "file", "block", "line", "value"))
    return reduce(DataFrame.unionByName, frames)


def read_lines(
    spark: SparkSession, paths: Sequence[str], *, spread: int | None = None
) -> DataFrame:
    """All lines of files or folders, in load order."""
    return read_files(spark, list_files(paths), spread=spread)


def read_heads(spark: SparkSession, files: Sequence[tuple[int, str]]) -> DataFrame:
    """Lines up to each file's first JSON object.

    Only the start of every file is opened, so asking what a dump holds does not scan it.
    """
    return longzstd.scan(spark, [name for _, name in files], head=True)
