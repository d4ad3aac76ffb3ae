"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of the words of the mix by weight, at most ``most`` times its own size; what is
above is shared again by weight. A document's expected copies are its source's target by its source's
size. Whole copies are certain; for the rest documents are ranked by Pareto's ratio, the odds of a
uniform number over the odds of inclusion, and taken in that order until the words of the target are
filled, so a sample has a fixed size in words. The last document taken counts with the words that were
still missing. ``prefer`` makes inclusion unequal within a source: odds follow its values.

Uniform numbers come from a digest of the key, so reruns agree. Ranks are not computed over a source as
one group: ratios fall into ``SLOTS`` slots, words are counted by source and slot, and only the slot in
which the target is reached is sorted.

Null and empty texts have size 0 and nothing of them is taken; null sources are one source, last in
order; repeated rows are documents of their own; a null or negative preference counts as 0, and where
all are 0 the preference is dropped. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionlake.llm.common import ready
from mentionlake.session import materialize, small_side

SLOTS = 4096
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def shares(sizes: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size); weights repeat over sources in order.

    One row per source: the windows run over sources, never over documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (
        F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * most)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * percent / 100)
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("level", level)
        .withColumn("common", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
        .select("source", "source_size", F.least(
            F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("common"), F.col("limit").cast("double"))
        ).alias("target"))
    )


def uniform(key: Column) -> Column:
    """A number strictly between 0 and 1 for each key."""
    digits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), key.cast("string")).cast("binary")), 1, 12), 16, 10)
    return (digits.cast("double") + 0.5) / float(1 << 48)


def sized(docs: DataFrame, prefer: Column | None, key: str, text: str, source: str) -> DataFrame:
    """Key, source, preference and size of every row, the row itself in one struct: whatever its columns are
    called, they meet no name used here."""
    wanted = F.lit(1.0) if prefer is None else F.greatest(F.coalesce(prefer.cast("double"), F.lit(0.0)), F.lit(0.0))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col(key).alias("key"), F.col(source).alias("source"),
        wanted.alias("wanted"), size.alias("size"))


class Sample:
    """What is decided for sources: targets, and up to which ratio documents are taken."""

    def __init__(self, docs: DataFrame, weights, percent, most, prefer, key, text, source):
        ready(docs.sparkSession)
        self.rows = materialize(sized(docs, prefer, key, text, source).drop("row"), "sizes")
        wish = F.sum(F.col("size") * F.col("wanted"))
        sums = self.rows.groupBy("source").agg(F.sum("size").alias("source_size"), wish.alias("wish"))
        targets = shares(sums.select("source", "source_size"), weights, percent, most)
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        self.goals = materialize(
            targets.withColumnRenamed("source", "__s").join(
                sums.select(F.col("source").alias("__t"), "wish"), F.col("__s").eqNullSafe(F.col("__t")))
            .select(
                "__s", "source_size", "target", "wish", F.floor(rate).cast("long").alias("certain"),
                (rate - F.floor(rate)).alias("chance"),
                (F.round("target").cast("long") - F.floor(rate).cast("long") * F.col("source_size")).alias("rest"),
            ),
            "goals",
        )
        self.count = self.goals.count()
        filled = self.ranked(self.rows).groupBy("source", "slot").agg(F.sum("size").alias("words"), F.first("goal.rest").alias("rest"))
        through = F.sum("words").over(Window.partitionBy("source").orderBy("slot"))
        self.edges = materialize(
            filled.withColumn("through", through)
            .where((F.col("through") >= F.col("rest")) & (F.col("rest") > 0))
            .groupBy(F.col("source").alias("__s"))
            .agg(F.min(F.struct("slot", (F.col("rest") - F.col("through") + F.col("words")).alias("open"))).alias("edge")),
            "edges",
        )

    def ranked(self, sized_rows: DataFrame) -> DataFrame:
        """Rows with the goal of their source, Pareto's ratio and its slot."""
        goals = self.goals.select("__s", F.struct(*self.goals.columns[1:]).alias("goal"))
        odds = F.when(F.col("goal.wish") > 0, F.col("wanted") * F.col("goal.source_size") / F.col("goal.wish")).otherwise(F.lit(1.0))
        chance = F.greatest(F.least(F.col("goal.chance") * odds, F.lit(1 - 1e-9)), F.lit(1e-9))
        draw = uniform(F.col("key"))
        return (
            sized_rows.join(small_side(goals, self.count), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
            .withColumn("ratio", (draw / (1 - draw)) / (chance / (1 - chance)))
            .withColumn("slot", F.least(F.floor(F.col("ratio") / (1 + F.col("ratio")) * SLOTS), F.lit(SLOTS - 1)).cast("int"))
        )

    def edged(self, ranked: DataFrame) -> tuple[DataFrame, Column]:
        """Ranked rows with the edge of their source, and whether they lie at it."""
        rows = ranked.join(small_side(self.edges, self.count), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        return rows, F.coalesce(F.col("slot") == F.col("edge.slot"), F.lit(False))

    def at_edge(self) -> DataFrame:
        """Rows at the edge of their source with the words taken of them beside whole copies."""
        rows, at_edge = self.edged(self.ranked(self.rows))
        order = Window.partitionBy("source").orderBy("ratio", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
        left = F.col("edge.open") - F.coalesce(F.sum("size").over(order), F.lit(0))
        return rows.where(at_edge).withColumn("extra", F.greatest(F.lit(0), F.least("size", left)))

    def away(self) -> DataFrame:
        """All other rows: taken whole before the edge and not at all behind it."""
        rows, at_edge = self.edged(self.ranked(self.rows))
        return rows.where(~at_edge).withColumn("extra", F.when(F.col("slot") < F.col("edge.slot"), F.col("size")).otherwise(0))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2,
    prefer: Column | None = None, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """(key, size, source_size, target, taken, source) of every row."""
    sample = Sample(docs, weights, percent, most, prefer, key, text, source)
    return sample.at_edge().unionByName(sample.away()).select(
        F.col("key").alias(key), "size", "goal.source_size", "goal.target",
        (F.col("goal.certain") * F.col("size") + F.col("extra")).cast("long").alias("taken"), F.col("source").alias(source),
    )


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2,
    prefer: Column | None = None, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, always whole; rows it does not take are gone.

    Only rows in the one slot at the edge of each source are looked up; all others are decided where
    they lie, so texts are not shuffled.
    """
    sample = Sample(docs, weights, percent, most, prefer, key, text, source)
    chosen = materialize(
        sample.at_edge().where("extra > 0").select(F.col("key").alias("__k"), F.col("source").alias("__s"), F.col("size").alias("__z")).distinct(),
        "at-edge",
    )
    rows, at_edge = sample.edged(sample.ranked(sized(docs, prefer, key, text, source)))
    same = F.col("key").eqNullSafe(F.col("__k")) & F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z"))
    more = F.when(at_edge, F.col("__z").isNotNull()).otherwise(F.coalesce(F.col("slot") < F.col("edge.slot"), F.lit(False)))
    return (
        rows.join(small_side(chosen, chosen.count()), same, "left")
        .withColumn("__copies", F.when(F.col("size") > 0, F.col("goal.certain") + more.cast("int")).otherwise(0))
        .where("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
        .select("row.*")
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM z),
r AS (SELECT *, 2 * source_size AS lim, 2 * source_size / weight AS ratio FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM z) * 150 / 100
                 - coalesce(sum(lim) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / ((SELECT sum(weight) FROM w)
         - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM r),
t AS (SELECT source, source_size, least(CAST(lim AS DOUBLE), coalesce(weight * (SELECT max(lev) FROM l WHERE ratio > lev), lim)) AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
h AS (SELECT *, CAST(floor(rate) AS BIGINT) AS certain, round(target) - floor(rate) * source_size AS rest,
             greatest(least(rate - floor(rate), 1 - 1e-9), 1e-9) AS chance FROM g),
u AS (SELECT d.doc_id, d.size, d.source, h.source_size, h.target, h.certain, h.rest, h.chance,
             (CAST(('0x' || substr(md5('mix:' || d.doc_id), 1, 12)) AS BIGINT) + 0.5) / 281474976710656.0 AS draw
      FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
q AS (SELECT *, (draw / (1 - draw)) / (chance / (1 - chance)) AS p FROM u),
c AS (SELECT *, rest - coalesce(sum(size) OVER (PARTITION BY source ORDER BY p, doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS missing FROM q)
SELECT doc_id, size, source_size, target, CAST(certain * size + greatest(0, least(size, missing)) AS BIGINT) AS taken
FROM c
"""
