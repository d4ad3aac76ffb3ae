"""Which rows of a stream are new, told by the state store instead of the table.

The keys of rows younger than a horizon are kept as state of a de-duplication with a watermark on the
creation time. A row above the watermark whose key is not in the state was never seen, so it is appended
without a look into the table. Rows at or below the watermark, which the state has forgotten or would drop,
are looked up in the table as any load does. So are rows no younger than what the table held before the
stream began, and all rows of a batch that is run again after a failure, because part of them may have been
written. Results are those of a load with look-ups, whatever the horizon and however late a row comes.

From its first batch on the stream has to be the only writer of rows younger than the horizon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.operators import archive
from mentionlake.operators.snapshots import path_exists

_MARK = "batch bigint, newest bigint, floor bigint"
_HOUR = 3_600_000_000  # microseconds


def with_unseen(judged: DataFrame, hours: int) -> DataFrame:
    """The judged lines, and besides them one row with ``unseen`` (id, created_utc) for each key above the
    watermark that comes for the first time. The second reading of the lines takes the keys only."""
    keys = judged.filter("status = 'matched'").select("row.id", "row.created_utc").dropna()
    first = keys.withWatermark("created_utc", f"{hours} hours").dropDuplicates(archive.KEYS)
    return judged.unionByName(first.select(F.struct(*archive.KEYS).alias("unseen")), allowMissingColumns=True)


class Marks:
    """How far creation times had come in the last batches, kept beside the checkpoint in two places that
    are written in turn, so that one is whole whenever the driver is lost."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> dict[int, tuple[int | None, int | None]]:
        """Batch number to (newest creation time up to it, newest in the table before the stream)."""
        places = [f"{self.folder}/place={i}" for i in (0, 1)]
        whole = [p for p in places if path_exists(self.spark, f"{p}/_SUCCESS")]
        rows = [self.spark.read.schema(_MARK).parquet(p).first() for p in whole]  # one row each
        return {r.batch: (r.newest, r.floor) for r in rows}

    def write(self, batch: int, newest: int | None, floor: int | None) -> None:
        row = self.spark.createDataFrame([(batch, newest, floor)], _MARK).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.folder}/place={batch % 2}")


def _newest(rows: DataFrame) -> int | None:
    return rows.agg(F.unix_micros(F.max("created_utc"))).first()[0]


def _highest(*moments: int | None) -> int | None:
    return max((m for m in moments if m is not None), default=None)


def add_batch(batch: DataFrame, number: int, table: str, marks: Marks, hours: int, buckets: int | None = None) -> None:
    """Write one micro-batch of ``with_unseen``."""
    spark = batch.sparkSession
    staged = archive.numbered(batch)
    rows = archive.staged_rows(staged).dropna(subset=archive.KEYS)
    known = marks.read()
    if number in known:  # begun before: part of it may be in the table
        archive.add_rows(rows, table, buckets)
        return
    if known:
        newest, floor = known.get(number - 1, (None, None))
    else:
        newest, floor = None, _newest(spark.read.parquet(table)) if path_exists(spark, table) else None
    in_order = not known or number - 1 in known
    own = _newest(rows)
    marks.write(number, _highest(newest, own), floor)
    if own is None:  # a batch without rows, in which the state forgets
        return
    if not in_order:
        archive.add_rows(rows, table, buckets)
        return
    bound = _highest(newest - hours * _HOUR if newest is not None else None, floor)
    unseen = staged.filter("unseen IS NOT NULL").select("unseen.*")
    if bound is not None:
        older = rows.filter(F.unix_micros("created_utc") <= bound)
        if not older.isEmpty():
            archive.add_rows(older, table, buckets)
        rows = rows.filter(F.unix_micros("created_utc") > bound)
    archive.add_unseen(rows, unseen, table, buckets)
