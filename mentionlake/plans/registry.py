"""Registered queries: name -> (function of session and data folder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.session import prepare

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    oracle: str | None


QUERIES: dict[str, Query] = {}


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less UTC values, the way the oracle reports them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``."""

    def register(fn: QueryFunction) -> QueryFunction:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_zone(fn(prepare(spark), sf_dir))

        QUERIES[name] = Query(run, oracle)
        return fn

    return register
