"""Running values along an ordered sequence whose keys may be very uneven.

A plain window over (key, time) puts all rows of a key in one task. Here the rows are dealt by range
into evenly filled slices of the whole (key, order) sequence; windows run inside (key, slice), and
what earlier slices pass on comes from a table of one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from mentionlake.session import materialize, small_side

SLICE = "_slice"


def in_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    local: Callable[[DataFrame, WindowSpec], DataFrame],
    slices: int | None = None,
) -> DataFrame:
    """Rows with their slice number and what ``local`` adds from the window inside (key, slice).

    ``order`` must be unique inside a key. The result is written out: range bounds are sampled, so a
    second evaluation could cut the sequence elsewhere.
    """
    count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(count, *keys, *order).withColumn(SLICE, F.spark_partition_id())
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    return materialize(local(dealt, inside), "slices")


def with_carry(
    table: DataFrame,
    keys: Sequence[str],
    summary: Mapping[str, Column],
    carry: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """``table`` with the columns that ``carry`` derives for each slice from the slices before it.

    ``summary`` aggregates a slice; ``carry`` gets those rows and the window over earlier slices.
    """
    tails = materialize(
        table.groupBy(*keys, SLICE).agg(*[c.alias(n) for n, c in summary.items()]), "tails"
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = carry(tails, before).drop(*summary)
    return table.join(small_side(carried, tails.count()), [*keys, SLICE])


def run_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], breaks: Column
) -> DataFrame:
    """Adds ``pos``, the row's 1-based position in its key, and ``break_pos``, the position of the
    latest row up to this one where ``breaks`` held (NULL before the first)."""

    def local(rows: DataFrame, inside: WindowSpec) -> DataFrame:
        numbered = rows.withColumn("_at", F.row_number().over(inside).cast("bigint"))
        return numbered.withColumn("_break", F.max(F.when(breaks, F.col("_at"))).over(inside))

    def carry(tails: DataFrame, before: WindowSpec) -> DataFrame:
        moved = tails.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        last = F.col("_offset") + F.col("_last_break")
        return moved.withColumn("_carried", F.max(last).over(before))

    table = in_slices(df, keys, order, local)
    summary = {"_n": F.count(F.lit(1)), "_last_break": F.max("_break")}
    placed = with_carry(table, keys, summary, carry)
    return placed.withColumns(
        {
            "pos": F.col("_at") + F.col("_offset"),
            "break_pos": F.coalesce(F.col("_break") + F.col("_offset"), F.col("_carried")),
        }
    ).drop("_at", "_break", "_offset", "_carried")


def last_seen(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column
) -> DataFrame:
    """Adds ``name``: the latest non-null ``value`` along the key, up to and including the row.

    ``sliced`` comes from ``in_slices`` or ``run_positions``.
    """
    so_far = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def carry(tails: DataFrame, before: WindowSpec) -> DataFrame:
        return tails.withColumn("_carried", F.last("_tail", ignorenulls=True).over(before))

    summary = {"_tail": F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))}
    carried = with_carry(sliced, keys, summary, carry)
    local = F.last(value, ignorenulls=True).over(so_far)
    return carried.withColumn(name, F.coalesce(local, F.col("_carried"))).drop("_carried")


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column
) -> DataFrame:
    """Adds ``name``: ``value`` of the row before, along the key (NULL for the first row)."""

    def local(rows: DataFrame, inside: WindowSpec) -> DataFrame:
        return rows.withColumn("_value", value).withColumn("_lag", F.lag("_value").over(inside))

    def carry(tails: DataFrame, before: WindowSpec) -> DataFrame:
        return tails.withColumns(
            {"_carried": F.last("_tail").over(before), "_first": F.col("_head")}
        )

    at = F.struct(*order)
    summary = {"_tail": F.max_by("_value", at), "_head": F.min(at)}
    table = with_carry(in_slices(df, keys, order, local), keys, summary, carry)
    is_first = at == F.col("_first")
    value_before = F.when(is_first, F.col("_carried")).otherwise(F.col("_lag"))
    return table.withColumn(name, value_before).drop("_value", "_lag", "_carried", "_first")
