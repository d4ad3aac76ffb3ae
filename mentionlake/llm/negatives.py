"""Hard negatives by threshold joins over inverted indexes with norm bounds.

Components are quantised to whole numbers, ``floor(scale * x)``, and scores are exact inner products of
these. Every anchor has windows of scores; a window wants the ``k`` best rows whose score lies in it, ties
by the smaller id. Positives are one window without bounds over rows of the anchor's label; the negatives
of a positive are a window from ``floor_percent`` of its score up to its score, over rows of other labels.

Rows are dealt by a hash of their id into slabs (for positives within their label, so a label with most
rows is many slabs), anchors are copied to the slabs they search. A slab is an inverted index, dimensions
in order of their energy: an entry is left out where the norm of what follows in its row, times the
largest anchor norm, stays below the lowest threshold. Partial scores of a block of anchors are
accumulated dimension by dimension in groups; a row is dropped when its partial score plus the product of
the remaining norms cannot reach the anchor's threshold, and what is left is scored exactly. Thresholds
start high and are lowered until the windows are full or their lower ends are reached.

Two rounds: the first slab of each label or of all rows, a uniform sample, yields windows that may be full
already; the ``k``-th best there is a proven lower end for the same window over the other slabs. Nothing is
capped, so results are exact; each slab gives at most ``k`` rows for a window. Memory is bounded by a slab and a block of anchors.

Rows with a null id, label or vector, or a null or non-finite component take no part; of several rows of
one id the least (label, vector) counts. Vectors are compared where lengths agree; empty and zero vectors
score 0. Rows whose quantised norm is 2**31 or more take no part, so that scores fit 64 bits. Further
columns are ignored. An empty table, or no anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionlake.llm.common import meet, ready
from mentionlake.session import materialize

SLAB = 4096  # rows of an index
BLOCK = 64  # anchors whose scores are held at a time
GROUPS = 8  # groups of dimensions
LEVELS = (0.9, 0.5, 0.25)  # thresholds, as parts of the score to start from
TOP = 2**62  # above every score

FOUND = "anchor bigint, win int, id bigint, score bigint"


def quantised(rows: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """(id, label, vec, dim) of the rows that take part, one for each id."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    size = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return (
        rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                    F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
        .where(~odd)
        .select("id", "label", whole.alias("vec"))
        .where(size < float(2**62))
        .groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row"))
        .select("id", "row.*", F.size("row.vec").alias("dim"))
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of one length."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), width) for c in chunks]
    return np.concatenate(parts)


class Index:
    """A slab: rows of one length, their dimensions in order of energy, and norms of what follows."""

    def __init__(self, rows: pa.Table):
        self.dim = rows["dim"][0].as_py()
        self.ids = rows["id"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.whole = matrix(rows["vec"], self.dim)
        x = self.whole.astype(np.float64)
        self.order = np.argsort(-(x**2).sum(axis=0), kind="stable")
        self.edges = np.unique(np.linspace(0, self.dim, GROUPS + 1).astype(int))
        self.x = x[:, self.order]
        self.rest = self._rest(self.x)

    def _rest(self, x: np.ndarray) -> np.ndarray:
        """Norms of the rows from each edge on."""
        squares = np.c_[(x**2)[:, ::-1].cumsum(axis=1)[:, ::-1], np.zeros(len(x))]
        return np.sqrt(squares[:, self.edges])

    def exact(self, anchors: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Scores of pairs of an anchor and a row."""
        out = np.empty(len(a), np.int64)
        for at in range(0, len(a), 1 << 15):
            part = slice(at, at + (1 << 15))
            out[part] = (anchors[a[part]] * self.whole[b[part]]).sum(axis=1)
        return out

    def above(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs whose score is at least the anchor's threshold."""
        a = anchors.astype(np.float64)[:, self.order]
        rest = self._rest(a)
        largest, lowest = rest[:, 0].max(initial=0), least.min(initial=TOP)
        slack = 1 + 1e-9 * largest * self.rest[:, 0].max(initial=0)  # what rounding may cost a bound
        depth = (self.rest * largest + slack >= lowest)[:, :-1].sum(axis=1)  # groups of a row that are indexed
        reach = np.argsort(-depth, kind="stable")  # rows with the longest indexed part first
        reach = reach[: np.count_nonzero(depth)]
        if not len(self.edges) - 1:  # empty vectors score 0
            reach = np.arange(len(self.ids))
        partial = np.zeros((len(a), len(reach)))
        bound = np.full((len(a), len(reach)), np.inf)
        for g, (start, end) in enumerate(zip(self.edges[:-1], self.edges[1:])):
            n = np.count_nonzero(depth[reach] > g)
            if not n:
                break
            partial[:, :n] += a[:, start:end] @ self.x[reach[:n], start:end].T
            bound[:, :n] = partial[:, :n] + rest[:, g + 1, None] * self.rest[reach[:n], g + 1] + slack
            alive = (bound >= least[:, None]).any(axis=0)
            if alive.mean() < 0.5:
                reach, partial, bound = reach[alive], partial[:, alive], bound[:, alive]
        i, j = np.nonzero(bound >= least[:, None])
        j = reach[j]
        score = self.exact(anchors, i, j)
        kept = score >= least[i]
        return i[kept], j[kept], score[kept]


def _filled(i: np.ndarray, score: np.ndarray, ends: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """Which windows of which anchors hold k of the pairs."""
    high, low = ends
    inside = (score[:, None] <= high[i]) & (score[:, None] >= low[i])
    counts = np.zeros(high.shape, np.int64)
    np.add.at(counts, i, inside)
    return counts >= k


def _search(index: Index, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray | None,
            ends: tuple[np.ndarray, np.ndarray], k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of the index in each window; rows of ``labels`` are left out where given."""
    high, low = ends
    bottom = low.min(axis=1)
    bounds = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1)) * index.rest[:, 0].max(initial=0)
    start = np.minimum(high.min(axis=1).astype(np.float64), bounds)
    open_rows = np.arange(len(ids))
    for level in (*LEVELS, None):
        least = bottom[open_rows] if level is None else np.maximum(bottom[open_rows], np.floor(level * start[open_rows]).astype(np.int64))
        if level is not None and (start[open_rows] <= 0).any():
            least = np.where(start[open_rows] <= 0, bottom[open_rows], least)
        i, j, score = index.above(anchors[open_rows], least)
        own = index.ids[j] != ids[open_rows][i]
        if labels is not None:
            own &= index.labels[j] != labels[open_rows][i]
        i, j, score = i[own], j[own], score[own]
        span = high[open_rows], low[open_rows]
        # a window is done when it is full, or when nothing below the threshold can lie in it
        done = (_filled(i, score, span, k) | (span[1] >= least[:, None])).all(axis=1)
        ready_pairs = done[i]
        i, j, score = i[ready_pairs], j[ready_pairs], score[ready_pairs]
        best = np.lexsort((index.ids[j], -score, i))
        i, j, score = i[best], j[best], score[best]
        for w in range(high.shape[1]):
            inside = np.flatnonzero((score <= span[0][i, w]) & (score >= span[1][i, w]))
            of = i[inside]
            rank = np.arange(len(of)) - np.searchsorted(of, of)
            top = inside[rank < k]
            if len(top):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[open_rows][i[top]]), pa.array(np.full(len(top), w, np.int32)),
                     pa.array(index.ids[j[top]]), pa.array(score[top])],
                    ["anchor", "win", "id", "score"],
                )
        open_rows = open_rows[~done]
        if not len(open_rows):
            break


def _searcher(k: int, same_label: bool):
    def probe(index: Index, asks: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if asks.column("dim")[0].as_py() != index.dim:
            return
        wins = np.diff(asks.column("high").offsets.to_numpy())
        anchors, ids, labels = matrix(asks.column("vec"), index.dim), asks.column("id").to_numpy(), asks.column("label").to_numpy()
        for count in np.unique(wins[wins > 0]):
            rows = np.flatnonzero(wins == count)
            ends = [matrix(asks.column(c).take(pa.array(rows)), int(count)) for c in ("high", "low")]
            for at in range(0, len(rows), BLOCK):
                part, block = rows[at : at + BLOCK], slice(at, at + BLOCK)
                yield from _search(index, anchors[part], ids[part], None if same_label else labels[part],
                                   (ends[0][block], ends[1][block]), k)

    def run(batches):
        yield from meet(batches, ["home", "slab"], Index, probe)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def windows(rows: DataFrame, asks: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor, win, id, score, rank): the k best rows in each window.

    ``asks`` has id, label, dim, vec and the ends of its windows in ``high`` and ``low``. Rows of the
    anchor's label are searched, or those of all others.
    """
    home = F.xxhash64(*(["dim", "label"] if same_label else ["dim"]))
    placed = rows.withColumn("home", home)
    sizes = materialize(placed.groupBy("home").agg(F.ceil(F.count("*") / SLAB).cast("int").alias("slabs")), "slabs")
    slab = F.pmod(F.xxhash64("id"), F.col("slabs")).cast("int")
    columns = ["home", "slab", "role", "id", "label", "dim", "vec", "high", "low"]
    none = F.array().cast("array<bigint>")
    stored = placed.join(sizes, "home").withColumns({"slab": slab, "role": F.lit(0), "high": none, "low": none}).select(columns)
    asking = asks.withColumn("home", home).withColumn("role", F.lit(1)).join(sizes, "home")

    def search(kept: Column, asks: DataFrame, slabs: Column) -> DataFrame:
        copies = asks.withColumn("slab", F.explode(slabs)).select(columns)
        dealt = stored.where(kept).unionByName(copies).repartition("home", "slab").sortWithinPartitions("home", "slab", "role")
        return dealt.mapInArrow(_searcher(k, same_label), FOUND)

    first = materialize(_best(search(F.col("slab") == 0, asking, F.array(F.lit(0))), k), "first-slabs")
    if not sizes.where("slabs > 1").limit(1).count():
        return first
    # the k-th best of the first slab is a lower end for the same window elsewhere
    ends = first.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("ends"))
    raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.element_at("ends", i), F.lit(-TOP))))
    asking = asking.where("slabs > 1").join(ends.withColumnRenamed("anchor", "id"), "id", "left").withColumn("low", raised)
    others = search(F.col("slab") > 0, asking, F.sequence(F.lit(1), F.col("slabs") - 1))
    return _best(first.drop("rank").unionByName(others), k)


def mine(
    rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 5, floor_percent: int = 80,
    scale: float = 256.0, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the column ``id``. Each anchor's ``positives`` best rows of its label are
    positives; for each, the ``negatives`` best rows of other labels with a score from ``floor_percent`` of
    the positive's up to it.
    """
    ready(rows.sparkSession)
    usable = materialize(quantised(rows, key, vector, label, scale), "quantised")
    asks = usable.where(anchors)
    whole = lambda x: F.array(F.lit(x).cast("long"))
    near = windows(usable, asks.withColumns({"high": whole(TOP), "low": whole(-TOP)}), positives, True)
    near = materialize(near.select("anchor", F.col("id").alias("positive_id"), "rank", F.col("score").alias("positive_score")), "positives")
    # 100 * negative >= percent * positive, in whole numbers; a negative positive has no window
    low = F.expr(f"(positive_score * {floor_percent} + 99) div 100")
    spans = near.where("positive_score >= 0").withColumn("low", low)
    ends = spans.groupBy(F.col("anchor").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", F.col("positive_score").alias("high"), "low"))).alias("spans"))
    asking = asks.join(ends, "id").select(
        "id", "label", "dim", "vec", F.col("spans.high").alias("high"), F.col("spans.low").alias("low"))
    found = windows(usable, asking, negatives, False)
    return found.join(ends.withColumnRenamed("id", "anchor"), "anchor").select(
        F.col("anchor").alias("anchor_id"),
        F.col("spans")[F.col("win")]["positive_id"].alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("spans")[F.col("win")]["high"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


ORACLE = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum([p[1] * p[2] for p in list_zip(a.v, b.v)]), 0) AS BIGINT) AS score
  FROM r AS a JOIN r AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5"""
