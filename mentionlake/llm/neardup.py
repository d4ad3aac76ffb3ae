"""Near-duplicate vectors by Euclidean p-stable hashing.

Equal vectors are one class. Normalised vectors are projected on Gaussian directions, shifted and
quantised; several cells together are a bucket of one of several tables. How many follows from the number of
classes (``plan``): more projections, so that a vector shares buckets with about ``STRANGERS`` unrelated ones however
many there are, and as many tables as keep the chance to miss a pair at the threshold at ``MISSED``; nearer pairs are
missed more rarely still, and none below the threshold is linked. Vectors that share a bucket are compared exactly, in
blocks: a bucket of n vectors is dealt into pairs of blocks of about ``BLOCK`` vectors, so no group is larger
than two blocks; a task walks its groups in order, many to an Arrow batch. A pair that shares several buckets
counts in the first of its tables only.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, link
with nothing. Vectors of different length never link. One row per id comes back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mentionlake.llm.common import components, ready
from mentionlake.llm.vectors import matrices, norms, projections, usable
from mentionlake.llm.words import mix
from mentionlake.session import materialize

WIDTH = 2.0
STRANGERS = 1.0
MISSED = 0.025
BLOCK = 256
SMALL = 32  # rows of a group whose pairs are listed; larger groups are multiplied as matrices
PAIRS = 1 << 15  # that are compared at a time
GROUP = ["pos", "bucket", "low", "high"]


def same_cell(cosine: float) -> float:
    """Chance that two unit vectors fall into one cell of a projection."""
    ratio = WIDTH / math.sqrt(2 - 2 * cosine)
    outside = 1 + math.erf(-ratio / math.sqrt(2))
    return 1 - outside - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-(ratio**2) / 2))


def plan(classes: int, threshold: float) -> tuple[int, int]:
    """(projections of a table, tables) for so many vectors."""
    near, far = same_cell(threshold), same_cell(0.0)
    tries = -math.log(MISSED)
    count = max(1, math.ceil(math.log(max(tries * classes / STRANGERS, 2)) / math.log(near / far)))
    return count, math.ceil(math.log(MISSED) / math.log1p(-(near**count)))


def bucket_keys(x: np.ndarray, count: int, tables: int) -> np.ndarray:
    """Bucket of each row of ``x`` in each table."""
    unit = x / norms(x)[:, None]
    directions, offsets = projections(x.shape[1], tables * count, WIDTH)
    cells = np.floor((unit @ directions + offsets) / WIDTH).astype(np.int64).reshape(len(x), tables, count)
    key = np.full((len(x), tables), np.uint64(x.shape[1]))
    for j in range(count):
        key = mix(key ^ cells[:, :, j].astype(np.uint64))
    return (key >> np.uint64(32)).astype(np.uint32).astype(np.int32)


def _hashed(count: int, tables: int):
    def run(batches):
        for batch in batches:
            keys = np.zeros((batch.num_rows, tables), np.int32)
            packed: list[bytes] = [b""] * batch.num_rows
            for rows, x in matrices(batch, "vec"):
                keys[rows] = bucket_keys(x, count, tables)
                for i, row in zip(rows.tolist(), x):
                    packed[i] = row.tobytes()
            offsets = pa.array(np.arange(batch.num_rows + 1) * tables, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("members"), pa.array(packed, pa.binary()), lists],
                ["id", "members", "vec", "keys"],
            )

    return run


def _smallest_reachable(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id each row reaches in a small symmetric adjacency matrix."""
    label = ids.copy()
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == label).all():
            return label
        label = lower


class _Rows:
    """Rows of whole groups, in order."""

    def __init__(self, rows: pa.Table):
        self.ids, self.members, self.block, self.pos = (rows[c].to_numpy() for c in ("id", "members", "block", "pos"))
        self.split = rows["low"].to_numpy() != rows["high"].to_numpy()
        vec = rows["vec"].to_pylist()
        self.size = np.array([len(v) for v in vec])
        self.unit = np.zeros((len(vec), self.size.max() // 8))
        for s in np.unique(self.size):  # buckets of two lengths may share a 32-bit key
            own = np.flatnonzero(self.size == s)
            x = np.frombuffer(b"".join(vec[i] for i in own), np.float64).reshape(len(own), -1)
            self.unit[own, : s // 8] = x / norms(x)[:, None]
        self.keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(vec), -1)

    def counted_here(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of equal length that belong to this pair of blocks and share no earlier bucket."""
        out = (self.size[i] == self.size[j]) & (~self.split[i] | (self.block[i] != self.block[j]))
        at = np.flatnonzero(out)
        earlier = np.arange(self.keys.shape[1]) < self.pos[i[at], None]
        out[at] = ~((self.keys[i[at]] == self.keys[j[at]]) & earlier).any(axis=1)
        return out


def _small_groups(rows: _Rows, starts: np.ndarray, sizes: np.ndarray, threshold: float) -> Iterator[tuple]:
    """(id, links, root) of both sides of every linked pair of small groups."""
    group = np.repeat(np.arange(len(starts)), sizes)
    at = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes)])
    for step in range(1, int(sizes.max(initial=1))):
        first = np.flatnonzero(group[step:] == group[:-step])
        for part in range(0, len(first), PAIRS):
            i, j = at[first[part : part + PAIRS]], at[first[part : part + PAIRS] + step]
            near = np.flatnonzero((rows.unit[i] * rows.unit[j]).sum(axis=1) >= threshold)
            near = near[rows.counted_here(i[near], j[near])]
            i, j = i[near], j[near]
            root = np.minimum(rows.ids[i], rows.ids[j])
            yield np.r_[rows.ids[i], rows.ids[j]], np.r_[rows.members[j], rows.members[i]], np.r_[root, root]


def _large_group(rows: _Rows, start: int, size: int, threshold: float) -> tuple:
    """The same for one large group, links summed by row."""
    own = start + np.argsort(rows.ids[start : start + size], kind="stable")
    linked = rows.unit[own] @ rows.unit[own].T >= threshold
    np.fill_diagonal(linked, False)
    linked &= linked.T
    a, b = np.nonzero(linked)
    for at in range(0, len(a), PAIRS):
        i, j = a[at : at + PAIRS], b[at : at + PAIRS]
        away = ~rows.counted_here(own[i], own[j])
        linked[i[away], j[away]] = False
    links = linked @ rows.members[own]
    some = links > 0
    return rows.ids[own][some], links[some], _smallest_reachable(linked, rows.ids[own])[some]


def linker(threshold: float):
    """Compares the rows of each group: (id, links, root) of every class with a link."""

    def compare(rows: pa.Table, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        own, small = _Rows(rows), sizes <= SMALL
        found = list(_small_groups(own, starts[small], sizes[small], threshold)) if small.any() else []
        found += [_large_group(own, int(a), int(n), threshold) for a, n in zip(starts[~small], sizes[~small])]
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)]
        if columns and len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            keys = [rows[c].to_numpy() for c in GROUP]
            starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            # the last group may go on in the next batch
            last, held = int(starts[-1]), rows.slice(int(starts[-1]))
            if last:
                yield from compare(rows.slice(0, last), starts[:-1], np.diff(starts))
        if held is not None and held.num_rows:
            yield from compare(held, np.array([0]), np.array([held.num_rows]))

    return run


def link(rows: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every id of ``rows``."""
    ready(rows.sparkSession)
    vectors = materialize(usable(rows, key, vector), "vectors")
    classes = vectors.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("members"))
    count, tables = plan(vectors.count(), threshold)
    hashed = materialize(
        classes.select("id", "members", "vec").mapInArrow(
            _hashed(count, tables), "id bigint, members bigint, vec binary, keys array<int>"),
        "hashed",
    )
    buckets = hashed.select("id", F.posexplode("keys").alias("pos", "bucket"))
    shared = buckets.groupBy("pos", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    placed = (
        buckets.join(shared, ["pos", "bucket"])
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("id", "pos", "bucket", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    found = materialize(
        placed.join(hashed, "id").repartition(*GROUP).sortWithinPartitions(*GROUP, "id")
        .mapInArrow(linker(threshold), "id bigint, links bigint, root bigint"),
        "links",
    )
    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    by_class = (
        classes.join(counted, "id", "left").join(reached, F.col("id") == F.col("vertex"), "left")
        .select("vec", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("links"),
                F.coalesce("component", "id").alias("component"))
    )
    linked = vectors.join(by_class, "vec").select(F.col("id").alias("key"), "links", "component")
    everyone = rows.select(F.col(key).alias("key")).distinct()
    component = F.coalesce("component", F.col("key").cast("long"))
    return everyone.join(linked, "key", "left").select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("key") == component).alias("kept"),
    )
