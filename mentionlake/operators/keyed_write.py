"""First-wins de-duplication, insert-ignore and upserts as plain joins and aggregates.

File tables have no MERGE, so these return the rows to append or the new content of the touched
partitions; ``operators.layout`` writes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` becomes a group limit that runs before the shuffle as well, so a key with
    very many copies sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def insert_ignore(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """Incoming rows whose key is new, one per key. Running it again on its own result adds none."""
    fresh = first_wins(incoming, keys, order)
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def upsert_mutable(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    mutable: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Existing and incoming rows by key; a known key only takes over the mutable columns.

    The fixed columns stay those of the first row ever seen, the mutable ones those of the last,
    NULL included. Existing rows are joined once with the last values of the polled keys, so their
    other columns are neither aggregated nor compared; first rows are looked for among polled rows only.
    """
    last = latest_by_key(incoming.select(*keys, *mutable, *dict.fromkeys(order)), keys, order)
    last = last.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in mutable], F.lit(True).alias("_polled"))
    known = existing.join(last, list(keys), "left").select(
        *[
            F.when(F.col("_polled"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in mutable else F.col(c)
            for c in existing.columns
        ]
    )
    fresh = insert_ignore(existing, incoming, keys, order).drop(*mutable).join(last, list(keys))
    return known.unionByName(
        fresh.select(*[F.col(f"_new_{c}").alias(c) if c in mutable else F.col(c) for c in existing.columns])
    )


def upsert_stored(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    mutable: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """``upsert_mutable`` with one reading of ``existing``: a full join by key with the first and the last values
    of each incoming key. For rows that lie by key, which such a join need not move."""
    fixed = [c for c in existing.columns if c not in {*keys, *mutable}]
    by = F.struct(*order)
    polled = incoming.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.min_by(F.struct(F.lit(True).alias("_any"), *fixed), by).alias("_first"),
        F.max_by(F.struct(F.lit(True).alias("_any"), *mutable), by).alias("_last"),
    )
    both = existing.withColumn("_stored", F.lit(True)).join(polled, list(keys), "full")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in mutable:
            return F.when(F.col("_last").isNull(), F.col(c)).otherwise(F.col("_last").getField(c)).alias(c)
        return F.when(F.col("_stored"), F.col(c)).otherwise(F.col("_first").getField(c)).alias(c)

    return both.select(*map(value, existing.columns))


def replace_by_key(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Incoming rows replace existing ones of the same key entirely; the first incoming row counts."""
    new = first_wins(incoming, keys, order).select(*existing.columns)
    return existing.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def latest_by_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Key-value state: the values of the last log row of each key."""
    values = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values])
