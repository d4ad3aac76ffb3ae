"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

# SQL settings the operators rely on. Sizing (shuffle partitions, memory) stays with the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # json keeps the last of two equal keys; the VARIANT parser rejects the line unless told so
    "spark.sql.variant.allowDuplicateKeys": "true",
    # lets a top-2048 per key be cut before the shuffle as well as after it
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

MAX_BROADCAST_ROWS = 100_000


@cache
def _shipped(application: str) -> None:
    """Send this package to the Python workers of a session, once."""
    session = SparkSession.active()
    root = Path(__file__).parent
    bundle = Path(tempfile.mkdtemp(prefix="mentionlake-")) / "mentionlake.zip"
    with zipfile.ZipFile(bundle, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    session.sparkContext.addPyFile(str(bundle))


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created, and ship the package to its workers."""
    _shipped(spark.sparkContext.applicationId)
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "mentionlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


@cache
def _private_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="mentionlake-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one in ``spark.checkpoint.dir``.

    A private temporary folder is only used by a local session that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _private_dir(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where rows carry a value that a re-run could assign differently (a range-partition number)
    or are used more than once after expensive work. What is read afterwards is committed files, so
    losing an executor cannot change the result.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when its known row count is within the limit; else leave the join to AQE."""
    return F.broadcast(df) if rows <= limit else df
