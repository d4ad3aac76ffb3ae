"""What several operators share: batch sizes, text batches, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionlake.session import materialize, prepare

# Rows of an Arrow batch: bounds the memory of a Python worker when texts are long.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def ready(spark: SparkSession) -> SparkSession:
    """Apply the session settings of the package and the batch sizes."""
    prepare(spark)
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def texts(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with the texts of one of its columns; a missing text is empty."""
    for batch in batches:
        if batch.num_rows:
            yield batch, [x or "" for x in batch.column(column).to_pylist()]


def parts(rows: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``chars`` characters (or one longer text)."""
    part, size = [], 0
    for text in rows:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function`` for mapInArrow, giving memory it has freed back to the system when a task ends.

    Python workers are kept for the next task; what their allocators hold on to would count beside it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def share(key: str, count: Column, size: int, *more: str) -> Column:
    """Whether a row is among about ``size`` of ``count`` rows, picked by a hash of its key (and of ``more``)."""
    return F.pmod(F.xxhash64(key, *more), F.greatest(count, F.lit(1))) < size


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """The smallest vertex that each vertex of ``edges`` (a, b) reaches: (vertex, component).

    Alternates large stars and small stars until nothing changes; each round halves path lengths or
    better, is one shuffle by vertex with partial aggregation, and is written to the shared folder so
    that a lost executor costs no recomputation of earlier rounds. A vertex with very many neighbours
    is only ever aggregated (min) and joined, never collected.
    """
    pairs = materialize(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        after = materialize(small, label)
        changed = after.join(pairs, ["u", "v"], "left_anti").limit(1).count()
        changed = changed or pairs.join(after, ["u", "v"], "left_anti").limit(1).count()
        pairs = after
        if not changed:
            break
    roots = pairs.select(F.col("v").alias("vertex")).distinct()
    return (
        pairs.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("component"))
        .unionByName(roots.select("vertex", F.col("vertex").alias("component")))
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[list[int], pa.RecordBatch]]:
    """(key, rows) of each stretch of rows with equal keys; batch ends cut stretches. Keys are whole numbers."""
    for batch in batches:
        if batch.num_rows:
            columns = [batch.column(k).to_numpy() for k in keys]
            starts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)]).tolist()
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                yield [int(c[start]) for c in columns], batch.slice(start, end - start)


def meet(
    batches: Iterator[pa.RecordBatch],
    keys: list[str],
    build: Callable[[pa.Table], object],
    probe: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]],
) -> Iterator[pa.RecordBatch]:
    """Build from the rows with role 0 of each group, then probe with those of role 1, batch by batch.

    The rows come sorted by ``keys`` and role, so only what is built is held.
    """
    group, held, built = None, [], None
    for (*own, role), rows in runs(batches, [*keys, "role"]):
        if own != group:
            group, held, built = own, [], None
        if role == 0:
            held.append(rows)
        elif held:
            built = build(pa.Table.from_batches(held)) if built is None else built
            yield from probe(built, rows)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Other batches for what runs inside: more rows where all rows are short."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
