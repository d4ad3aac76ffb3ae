"""Raw tables whose rows lie in buckets by key inside each date.

A load or an upsert meets the stored rows by key. In a table laid out here the stored side is read bucket
by bucket, so only the incoming rows are shuffled, whatever the table holds. Buckets are known to Spark
through its catalog; a session that has not seen the table yet registers it over its folder. The number of
buckets belongs to the table: pass the same one always.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from mentionlake.operators.layout import PARTITION, with_date
from mentionlake.operators.snapshots import path_exists

KEYS = ("id", "created_utc")


def _name(table: str, buckets: int) -> str:
    return "raw_" + hashlib.md5(f"{table}:{buckets}".encode()).hexdigest()


def _register(spark: SparkSession, table: str, buckets: int, schema: StructType, keys: Sequence[str]) -> str:
    name = _name(table, buckets)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in keys)
        place = table.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({PARTITION}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        if path_exists(spark, table):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def read(spark: SparkSession, table: str, buckets: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """The rows of a table that exists."""
    name = _name(table, buckets)
    schema = None if spark.catalog.tableExists(name) else spark.read.parquet(table).schema
    return spark.table(_register(spark, table, buckets, schema, keys))


def _write(rows: DataFrame, table: str, buckets: int, keys: Sequence[str], overwrite: bool) -> None:
    spark = rows.sparkSession
    dated = rows if PARTITION in rows.columns else with_date(rows)
    name = _register(spark, table, buckets, dated.schema, keys)
    # a bucket of a date is one file, but the dates of a bucket are dealt to many tasks, which the writer sorts
    tasks = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = dated.select(*spark.table(name).columns).repartition(tasks, PARTITION, F.pmod(F.hash(*keys), F.lit(buckets)))
    placed.write.insertInto(name, overwrite=overwrite)


def append_rows(rows: DataFrame, table: str, buckets: int, keys: Sequence[str] = KEYS) -> None:
    """Append rows; each bucket of a date gets one more file."""
    _write(rows, table, buckets, keys, overwrite=False)


def overwrite_dates(rows: DataFrame, table: str, buckets: int, keys: Sequence[str] = KEYS) -> None:
    """Replace the dates that ``rows`` has, and only those. ``rows`` must not be read from ``table``."""
    spark = rows.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        _write(rows, table, buckets, keys, overwrite=True)
    finally:
        spark.conf.set(mode, before)
