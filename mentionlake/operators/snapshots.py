"""Small keyed tables as versions: every change is written to a new folder, readers take the latest.

Nothing is overwritten in place, so a failed write leaves the version before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PREFIX = "version="


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.getFileStatus(where).isDirectory()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions in ascending order."""
    files, where = _file_system(spark, root)
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    numbers = sorted(int(n.removeprefix(_PREFIX)) for n in names if n.startswith(_PREFIX))
    return [n for n in numbers if path_exists(spark, f"{root}/{_PREFIX}{n:08d}/_SUCCESS")]


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The latest version, or no rows when there is none yet."""
    found = versions(spark, root)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{_PREFIX}{found[-1]:08d}")


def write(rows: DataFrame, root: str) -> DataFrame:
    """Write the next version and return it."""
    spark = rows.sparkSession
    number = max(versions(spark, root), default=0) + 1
    path = f"{root}/{_PREFIX}{number:08d}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
