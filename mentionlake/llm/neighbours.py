"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Candidates are dealt by their norm into ranges, ``RANGES`` to an octave; in a
range they are scaled by its upper end and get one more component that makes them unit vectors; queries are
normalised and get a zero there. Then a larger inner product is a smaller Euclidean distance, and since
no candidate is much shorter than its range, very uneven norms hide none behind the added component. Each of
``TABLES`` tables quantises ``PROJECTIONS`` Gaussian projections into ``CELLS`` cells each (the outer ones are
open). For a query, the chance that a neighbour at cosine ``ASSUMED_COSINE`` lies in a bucket follows from the
normal distribution of its projections; buckets are visited from the likeliest down until the chances add up to
``SUCCESS``. Candidates of all tables are ranked by the exact inner product; ties go to the smaller id.
Nothing is capped: whatever lies in a visited bucket is compared. Recall is at least 1 - (1 - SUCCESS) **
TABLES for neighbours as near as assumed, and more for nearer ones. A query that has found fewer candidates
than it asks for, and fewer than there are, visits all buckets.

Candidates of a range are dealt by a hash of their id into slabs, whatever the sizes of buckets; a task holds a
slab, and the queries, copied to every slab of their length, stream past it.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, take
no part; of several vectors of one id the least counts; only vectors of equal length are compared. Further columns
are ignored. An empty table, or no query, gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionlake.llm.common import meet, ready
from mentionlake.llm.vectors import matrices, norms, normal, projections, usable
from mentionlake.session import materialize

TABLES = 2
PROJECTIONS = 3
CELLS = 8
WIDTH = 0.75
ASSUMED_COSINE = 0.25
SUCCESS = 0.78
RANGES = 5  # of norms, to a factor of two
SLAB = 32_768  # candidates that a task holds; each slab gives k rows for a query, so smaller slabs give more rows
ROWS = 64  # queries whose scores are held at a time


def _project(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    directions, offsets = projections(unit.shape[1], TABLES * PROJECTIONS, WIDTH)
    return (unit @ directions).reshape(-1, TABLES, PROJECTIONS), (offsets - WIDTH / 2).reshape(TABLES, PROJECTIONS)


def bucket_of(x: np.ndarray, largest: float | np.ndarray) -> np.ndarray:
    """Bucket of each row of ``x`` in each table; ``largest`` is the upper end of its norms."""
    scaled = x / np.reshape(largest, (-1, 1))
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
    along, offsets = _project(np.c_[scaled, rest])
    cells = np.clip(np.floor((along + offsets) / WIDTH) + CELLS // 2, 0, CELLS - 1).astype(np.int32)
    return cells @ (CELLS ** np.arange(PROJECTIONS)).astype(np.int32)


def probes(q: np.ndarray) -> np.ndarray:
    """Which buckets of each table each query visits: bits, packed."""
    unit = np.c_[q / norms(q)[:, None], np.zeros(len(q))]
    along, offsets = _project(unit)
    centre, spread = ASSUMED_COSINE * along + offsets, math.sqrt(1 - ASSUMED_COSINE**2)
    edges = (np.arange(CELLS + 1) - CELLS // 2) * WIDTH
    below = normal((edges[None, None, None, :] - centre[..., None]) / spread)
    below[..., 0], below[..., -1] = 0, 1
    chance = np.diff(below, axis=-1)
    total = chance[:, :, 0, :]
    for j in range(1, PROJECTIONS):  # the cell of projection j counts CELLS ** j
        total = (chance[:, :, j, :, None] * total[:, :, None, :]).reshape(len(q), TABLES, -1)
    order = np.argsort(-total, axis=-1, kind="stable")
    ranked = np.take_along_axis(total, order, axis=-1)
    visited = np.cumsum(ranked, axis=-1) - ranked < SUCCESS
    out = np.zeros_like(visited)
    np.put_along_axis(out, order, visited, axis=-1)
    return np.packbits(out, axis=-1)


def _candidates(batches):
    for batch in batches:
        for rows, x in matrices(batch, "vec"):
            length = np.minimum(norms(x), np.finfo(float).max)
            # an upper end may be passed by a little, so that unit vectors with rounding errors share the range of 1
            span = np.ceil(np.log2(length) * RANGES - 1e-4).astype(np.int32)
            keys = bucket_of(x / length[:, None], np.maximum(1.0, 2.0 ** (span / RANGES - np.log2(length))))
            ids = np.repeat(batch.column("id").to_numpy()[rows], TABLES)
            packed = [v.tobytes() for v in x for _ in range(TABLES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.tile(np.arange(TABLES, dtype=np.int32), len(rows))),
                 pa.array(np.full(len(ids), x.shape[1], np.int32)), pa.array(np.repeat(span, TABLES)),
                 pa.array(packed, pa.binary()), pa.array(keys.astype(np.int32).ravel())],
                ["id", "tab", "dim", "span", "vec", "bucket"],
            )


def _queries(everywhere: bool):
    """Queries with the buckets they visit, for each table; or, for one table, with all of them."""
    count = 1 if everywhere else TABLES

    def run(batches):
        for batch in batches:
            for rows, x in matrices(batch, "vec"):
                ids = np.repeat(batch.column("id").to_numpy()[rows], count)
                packed = [v.tobytes() for v in x for _ in range(count)]
                if everywhere:
                    bits = [b"\xff" * (CELLS**PROJECTIONS // 8)] * len(x)
                else:
                    bits = [b.tobytes() for row in probes(x) for b in row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.tile(np.arange(count, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(ids), x.shape[1], np.int32)), pa.array(packed, pa.binary()), pa.array(bits, pa.binary())],
                    ["id", "tab", "dim", "vec", "probes"],
                )

    return run


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    vec = column.to_pylist()
    return np.frombuffer(b"".join(vec), np.float64).reshape(len(vec), -1)


class Slab:
    """Candidates in order of their buckets."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("bucket", "ascending"), ("id", "ascending")])
        bucket = rows["bucket"].to_numpy()
        self.ids, self.x = rows["id"].to_numpy(), _matrix(rows["vec"])
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist()
        self.spans = [(int(bucket[a]), a, b) for a, b in zip(starts, [*starts[1:], len(bucket)])]


def searcher(k: int):
    """The ``k`` best rows of a slab for each query that streams past it."""

    def search(slab: Slab, queries: pa.RecordBatch):
        q, asked = _matrix(queries.column("vec")), queries.column("id").to_numpy()
        bits = np.unpackbits(np.frombuffer(b"".join(queries.column("probes").to_pylist()), np.uint8).reshape(len(q), -1), axis=1)
        out = {"query_id": [], "vec_id": [], "score": []}
        for first in range(0, len(q), ROWS):
            part = slice(first, first + ROWS)
            near = np.full((len(q[part]), len(slab.x)), -np.inf)
            for bucket, a, b in slab.spans:
                asking = np.flatnonzero(bits[part, bucket])
                near[asking, a:b] = q[part][asking] @ slab.x[a:b].T
            for own, vector, row in zip(asked[part].tolist(), q[part], near):
                row[slab.ids == own] = -np.inf
                floor = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                slack = 1e-9 * max(1.0, abs(floor)) if np.isfinite(floor) else 0.0
                at = np.flatnonzero((row >= floor - slack) & (row > -np.inf))
                exact = (slab.x[at] * vector).sum(axis=1)  # the same for equal vectors, wherever they stand
                best = np.lexsort((slab.ids[at], -exact))[:k]
                out["query_id"] += [own] * len(best)
                out["vec_id"] += slab.ids[at][best].tolist()
                out["score"] += exact[best].tolist()
        types = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in types.items()], list(types))

    def run(batches):
        yield from meet(batches, ["tab", "dim", "span", "slab"], Slab, search)

    return run


def nearest(rows: DataFrame, asks: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row where ``asks`` holds.

    ``asks`` is a condition on the column ``id``.
    """
    ready(rows.sparkSession)
    vectors = materialize(usable(rows, key, vector), "vectors")
    asking = vectors.where(asks)
    hashed = materialize(
        vectors.mapInArrow(_candidates, "id bigint, tab int, dim int, span int, vec binary, bucket int"), "hashed")
    sizes = materialize(
        hashed.where("tab = 0").groupBy("dim", "span").agg(F.count("*").alias("n"), F.ceil(F.count("*") / SLAB).cast("int").alias("slabs")),
        "slabs")
    columns = ["tab", "dim", "span", "slab", "role", "id", "vec", "bucket", "probes"]
    stored = hashed.join(sizes, ["dim", "span"]).withColumns({
        "slab": F.pmod(F.xxhash64("id"), F.col("slabs")).cast("int"), "role": F.lit(0), "probes": F.lit(None).cast("binary"),
    }).select(columns)

    def search(asking: DataFrame, everywhere: bool) -> DataFrame:
        queries = asking.select("id", "vec").mapInArrow(_queries(everywhere), "id bigint, tab int, dim int, vec binary, probes binary")
        copies = queries.join(sizes, "dim").withColumns({
            "slab": F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)), "role": F.lit(1), "bucket": F.lit(None).cast("int"),
        }).select(columns)
        kept = stored.where("tab = 0") if everywhere else stored
        order = ["tab", "dim", "span", "slab"]
        return kept.unionByName(copies).repartition(*order).sortWithinPartitions(*order, "role").mapInArrow(
            searcher(k), "query_id bigint, vec_id bigint, score double")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    def best(found: DataFrame) -> DataFrame:
        return found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", rank).where(F.col("rank") <= k)

    found = materialize(best(search(asking, False)), "found")
    # lists that are shorter than they could be
    others = sizes.groupBy("dim").agg((F.sum("n") - 1).alias("others"))
    counts = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("found"))
    short = (
        asking.withColumn("dim", F.size("vec")).join(others, "dim").join(counts, "id", "left")
        .where(F.coalesce("found", F.lit(0)) < F.least(F.col("others"), F.lit(k)))
    )
    short = materialize(short.select("id", "vec"), "short-lists")
    if short.limit(1).count():
        found = best(found.drop("rank").unionByName(search(short, True)))
    return found.select("query_id", "rank", "vec_id", "score")
