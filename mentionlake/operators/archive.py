"""The archive load as a job: lines to raw tables with counters and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.operators import bucketed, mapping, quality
from mentionlake.operators.keyed_write import first_wins, insert_ignore, upsert_mutable, upsert_stored
from mentionlake.operators.layout import PARTITION, append_rows, on_days, overwrite_dates, with_date
from mentionlake.operators.snapshots import path_exists
from mentionlake.session import materialize, small_side
from mentionlake.sources import jsonl

KEYS = ["id", "created_utc"]


@dataclass
class LoadStats:
    read: int = 0
    matched: int = 0
    inserted: int = 0
    skipped_malformed: int = 0
    skipped_filter: int = 0
    files: int = 0

    def merge(self, other: "LoadStats") -> None:
        for f in fields(self):
            setattr(self, f.name, getattr(self, f.name) + getattr(other, f.name))


def classify_lines(lines: DataFrame, kind: str, wanted: quality.LoadFilter) -> DataFrame:
    """Lines of one kind with their document and status."""
    parsed = quality.parse_lines(lines).withColumn("kind", F.lit(kind))
    return quality.with_status(parsed, wanted)


def judged(classified: DataFrame, kind: str) -> DataFrame:
    """Every line's status, the mapped row of matched ones and the text of malformed ones."""
    is_matched, is_malformed = F.col("status") == "matched", F.col("status") == "malformed"
    return classified.select(
        *[c for c in jsonl.ORDER if c in classified.columns],
        "status",
        F.when(is_matched, F.struct(*mapping.COLUMNS[kind]())).alias("row"),
        F.when(is_malformed, F.col("value")).alias("rejected"),
    )


def numbered(lines: DataFrame) -> DataFrame:
    """Judged lines written to the shared folder with a number each, which stands for the line in its
    file where the reader gives none."""
    number = F.monotonically_increasing_id()
    if "line" not in lines.columns:
        lines = lines.withColumn("line", number)
    return materialize(lines.withColumn("row_id", number), "load")


def stage(classified: DataFrame, kind: str) -> DataFrame:
    """The judged lines as committed files.

    The lines are parsed once, for this; counters, quarantine and rows all come from these columns.
    """
    return numbered(judged(classified, kind))


def staged_rows(staged: DataFrame) -> DataFrame:
    return staged.filter("status = 'matched'").select("row.*", "row_id", *jsonl.ORDER)


def quarantined(staged: DataFrame) -> DataFrame:
    """Malformed lines with their place of origin."""
    return staged.filter("status = 'malformed'").select("file", "block", "line", "rejected")


def counted(staged: DataFrame) -> LoadStats:
    def having(status: str):
        return F.count_if(F.col("status") == status)

    row = staged.agg(
        F.count(F.lit(1)).alias("read"),
        having("matched").alias("matched"),
        having("malformed").alias("skipped_malformed"),
        having("filtered").alias("skipped_filter"),
    ).first()
    return LoadStats(**row.asDict())


def _stored(spark: SparkSession, table: str, buckets: int | None) -> DataFrame:
    return bucketed.read(spark, table, buckets) if buckets else spark.read.parquet(table)


def add_rows(rows: DataFrame, table: str, buckets: int | None = None) -> int:
    """Append the staged rows the table does not have yet; returns how many there were.

    In a table of ``buckets`` (see ``operators.bucketed``) the stored keys are not moved. Which rows to
    leave out is worked out on keys and places alone. The rows themselves, with their payload, are only
    shuffled to be laid out: what is left out is usually little and broadcast.
    """
    spark = rows.sparkSession
    rows = rows.dropna(subset=KEYS)  # without a key a row would be added again by every load
    dated = with_date(rows)
    # calendar days, as literals: an anti-join would not prune the table's folders by itself
    days = [row[0] for row in dated.select(PARTITION).distinct().toLocalIterator()]
    if path_exists(spark, table):
        known = _stored(spark, table, buckets).filter(on_days(days))
    else:
        known = spark.createDataFrame([], dated.select(*KEYS).schema)
    fresh = insert_ignore(known, rows.select(*KEYS, "row_id", *jsonl.ORDER), KEYS, jsonl.ORDER)
    return _append_only(fresh.select("row_id"), rows, table, buckets)


def add_unseen(rows: DataFrame, unseen: DataFrame, table: str, buckets: int | None = None) -> int:
    """Append the staged rows whose key is in ``unseen``, the first of each key, without a look into the
    table: ``unseen`` holds the keys of these rows that are known not to be there."""
    rows = rows.dropna(subset=KEYS)
    fresh = first_wins(rows.select(*KEYS, "row_id", *jsonl.ORDER), KEYS, jsonl.ORDER)
    return _append_only(fresh.join(unseen, KEYS, "left_semi").select("row_id"), rows, table, buckets)


def _append_only(chosen: DataFrame, rows: DataFrame, table: str, buckets: int | None) -> int:
    """Append the rows with the ids in ``chosen``; returns how many there were."""
    left_out = materialize(rows.select("row_id").join(chosen, "row_id", "left_anti"), "left-out")
    copies, total = left_out.count(), rows.count()
    if copies < total:
        new = with_date(rows).join(small_side(left_out, copies), "row_id", "left_anti")
        new = new.drop("row_id", *jsonl.ORDER)
        new = new.withColumn("ingested_at", F.lit(datetime.now(timezone.utc)))
        if buckets:
            bucketed.append_rows(new, table, buckets)
        else:
            append_rows(new, table)
    return total - copies


def upsert_rows(
    polled: DataFrame, table: str, mutable: Sequence[str], order: Sequence[str], buckets: int | None = None
) -> None:
    """Add polled rows to a raw table; of rows it has, only the mutable columns change.

    Posts take over score and num_comments, comments take over score. Only the dates that were
    polled are read and rewritten.
    """
    spark = polled.sparkSession
    dated = with_date(polled.dropna(subset=KEYS)).withColumn("ingested_at", F.lit(datetime.now(timezone.utc)))
    dated = materialize(dated, "polled")
    days = [row[0] for row in dated.select(PARTITION).distinct().toLocalIterator()]
    if path_exists(spark, table):
        known = _stored(spark, table, buckets).filter(on_days(days))
    else:
        known = dated.drop(*{*order, *jsonl.ORDER} - {*KEYS, *mutable}).limit(0)
    upsert = upsert_stored if buckets else upsert_mutable
    merged = materialize(upsert(known, dated, KEYS, mutable, order), "merged")
    if buckets:
        bucketed.overwrite_dates(merged, table, buckets)
    else:
        overwrite_dates(merged, table)


def load_archive(
    spark: SparkSession,
    paths: Sequence[str],
    tables: dict[str, str],
    *,
    kind: str = "auto",
    wanted: quality.LoadFilter = quality.LoadFilter(),
    spread: int | None = None,
    quarantine: str | None = None,
    buckets: int | None = None,
) -> LoadStats:
    """Load dump files into ``tables`` ({"posts": path, "comments": path}) and count.

    Files are sorted by kind first (only their heads are read), then each kind is one job.
    ``quarantine`` is a folder that malformed lines are appended to. ``buckets`` lays the tables out by key.
    """
    files = jsonl.list_files(paths)
    kinds = {name: kind for _, name in files}
    if kind == "auto":
        # one short row per file the driver has just listed
        kinds = dict(quality.file_kinds(jsonl.read_heads(spark, files)).toLocalIterator())
        untold = [name for _, name in files if name not in kinds]
        if untold:
            raise ValueError(f"cannot tell the kind of files without an object: {untold[:3]}")
    total = LoadStats()
    for name in mapping.COLUMNS:
        chosen = [f for f in files if kinds[f[1]] == name]
        if not chosen:
            continue
        lines = jsonl.read_files(spark, chosen, spread=spread)
        staged = stage(classify_lines(lines, name, wanted), name)
        stats = counted(staged)
        stats.files = len(chosen)
        stats.inserted = add_rows(staged_rows(staged), tables[name], buckets)
        if quarantine:
            quarantined(staged).write.mode("append").parquet(quarantine)
        total.merge(stats)
    return total
