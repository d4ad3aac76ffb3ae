"""Byte-level BPE encoding and decoding.

Texts up to ``CHUNK`` characters are pre-tokenised where they lie. Longer ones are cut into overlapping
chunks that are spread over the cluster and pre-tokenised in parallel; the chunks of a text are stitched
at the first boundary both neighbours agree on, then its pieces are encoded. A match of the pattern
depends on nothing before its start, so from a common boundary on both tokenisations are the same; the
last characters of a chunk are not trusted, because a match or its look-ahead may reach past the cut.

Null and empty texts give no ids; repeated rows stay repeated; columns other than the key and the text
are ignored, whatever their names. Decoding null ids gives empty bytes.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from mentionlake.llm.common import parts, ready, tidy

CHUNK = 32_768  # characters of a chunk
OVERLAP = 1_024  # characters two neighbours share
MARGIN = 3  # longest literal of the pattern: boundaries closer to a cut are not trusted
LONG_PIECE = 48  # bytes from which a piece is merged with a heap instead of in a vector
CACHED_BYTES = 24_000_000  # of known pieces per Python worker and generation, of which there are two
ENTRY_BYTES = 160  # what a known piece takes besides its characters and ids
PART_CHARS = 250_000  # characters whose pieces are held at a time
NO_RANK = 1 << 40

_loaded: dict[tuple[int, str], "Vocabulary"] = {}
_spelled: dict[int, dict[int, bytes]] = {}


def ranked(ranks: bytes) -> Iterator[tuple[bytes, int]]:
    """(byte string, rank) of each line of a rank file."""
    for line in ranks.splitlines():
        if line.strip():
            token, rank = line.split()
            yield base64.b64decode(token), int(rank)


class Vocabulary:
    """Ranks of byte strings, and the pattern that splits a text before merging."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ids = dict(ranked(ranks))
        self.find = regex.compile(pattern).findall
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ids.items():
            for i in range(1, len(token)):
                left, right = self.ids.get(token[:i]), self.ids.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # ids, as bytes, of pieces met lately and of those met before these; bounded by their size
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.held = 0

    def _rank(self, key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of short pieces: in each round every piece merges its leftmost pair of least rank. Only the
        pairs on both sides of a merge are looked up again."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        own = np.repeat(np.arange(len(pieces)), sizes)
        out = [b""] * len(pieces)
        rank = np.full(len(ids), NO_RANK)
        inside = np.flatnonzero(own[:-1] == own[1:])
        while len(ids):
            rank[inside] = self._rank(ids[inside] << 20 | ids[inside + 1])
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(ids)])
            done = least == NO_RANK
            if done.any():
                packed = ids.astype(np.int32).tobytes()
                for i, s, n in zip(own[starts[done]].tolist(), starts[done].tolist(), lengths[done].tolist()):
                    out[i] = packed[4 * s : 4 * (s + n)]
            hit = np.flatnonzero((rank == np.repeat(least, lengths)) & (rank < NO_RANK))
            hit = hit[np.r_[True, own[hit[1:]] != own[hit[:-1]]]] if len(hit) else hit
            ids[hit] = rank[hit]
            keep = np.repeat(~done, lengths)
            keep[hit + 1] = False
            at = (np.cumsum(keep) - 1)[hit]  # where the merged ids lie afterwards
            ids, own, rank = ids[keep], own[keep], rank[keep]
            rank[at] = NO_RANK  # the last id of a piece has no pair
            beside = np.r_[at - 1, at]
            beside = beside[(beside >= 0) & (beside + 1 < len(ids))]
            inside = beside[own[beside] == own[beside + 1]]
        return out

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length, in n log n."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.pairs[k], i) for i in range(n - 1) if (k := ids[i] << 20 | ids[i + 1]) in self.pairs]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or self.pairs.get(ids[i] << 20 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := self.pairs.get(ids[left] << 20 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left))
        return [x for x in ids if x >= 0]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Looks up or merges all of ``pieces``; short ones stay known, long ones are returned."""
        if self.held > CACHED_BYTES:
            self.known, self.known_before, self.held = {}, self.known, 0
        apart, fresh, raw = {}, [], []
        for p in pieces.difference(self.known):
            ids = self.known_before.get(p)
            if ids is None:
                b = p.encode("utf-8", "surrogatepass")
                token = self.ids.get(b)
                if token is not None:
                    ids = token.to_bytes(4, sys.byteorder)
                elif len(b) > LONG_PIECE:
                    apart[p] = np.array(self.merge_long(b), np.int32).tobytes()
                    continue
                else:
                    fresh.append(p)
                    raw.append(b)
                    continue
            self.known[p] = ids
            self.held += len(p) + len(ids) + ENTRY_BYTES
        self.known.update(zip(fresh, merged := self.merge_many(raw)))
        self.held += sum(map(len, raw)) + sum(map(len, merged)) + ENTRY_BYTES * len(raw)
        return apart

    def encode_pieces(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Ids of texts that are given as lists of pieces; each distinct piece is merged once, and pieces
        seen before are looked up."""
        apart = self._learn(set().union(*texts))
        if apart:
            find = lambda p: self.known.get(p) or apart[p]
        else:
            find = self.known.__getitem__
        return [np.frombuffer(b"".join(map(find, pieces)), np.int32) for pieces in texts]


def loaded(ranks: bytes, pattern: str) -> Vocabulary:
    """The vocabulary, built once in each Python worker."""
    key = (hash(ranks), pattern)
    if key not in _loaded:
        _loaded[key] = Vocabulary(ranks, pattern)
    return _loaded[key]


def spelled(ranks: bytes) -> dict[int, bytes]:
    """The bytes of each id, built once in each Python worker. A worker that decodes needs no vocabulary."""
    key = hash(ranks)
    if key not in _spelled:
        _spelled[key] = {rank: token for token, rank in ranked(ranks)}
    return _spelled[key]


def boundaries(find, text: str) -> np.ndarray:
    """Where the pieces of ``text`` end."""
    return np.cumsum(np.fromiter(map(len, find(text)), np.int64))


def stitch(find, text: str, chunks: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Piece ends of a whole text from (start, end, piece ends) of its overlapping chunks.

    Where two neighbours share no boundary (a piece longer than the overlap), the text is
    pre-tokenised again from the last trusted boundary to the end of the next chunk.
    """
    trusted = lambda ends, end: ends if end >= len(text) else ends[ends <= end - MARGIN]
    _, end, ends = chunks[0]
    kept = trusted(ends, end)
    for _, end, ends in chunks[1:]:
        ends = trusted(ends, end)
        common = np.intersect1d(kept, ends, assume_unique=True)
        if len(common):
            kept = np.r_[kept[kept <= common[0]], ends[ends > common[0]]]
        else:
            last = int(kept[-1]) if len(kept) else 0
            kept = np.r_[kept, trusted(boundaries(find, text[last:end]) + last, end)]
    return kept


def _pieces(text: str, ends: np.ndarray) -> list[str]:
    bounds = [0, *ends.tolist()]
    return [text[a:b] for a, b in zip(bounds, bounds[1:])]


def encode(
    docs: DataFrame, ranks: bytes, pattern: str, key: str = "doc_id", text: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """(key, ids) of every row. ``ranks`` is the content of a rank file; it is broadcast."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(ranks)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def whole(batches):
        vocabulary = loaded(shared.value, pattern)
        for batch in batches:
            ids = []
            for part in parts(batch.column(1).to_pylist(), PART_CHARS):
                ids += vocabulary.encode_pieces([vocabulary.find(t) for t in part])
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            offsets = np.cumsum([0, *map(len, ids)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "ids"])

    def chunks(batches):
        vocabulary = loaded(shared.value, pattern)
        for batch in batches:
            ends = [boundaries(vocabulary.find, t) + s for t, s in
                    zip(batch.column("part").to_pylist(), batch.column("start").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.list_(pa.int64()))],
                                             [*batch.schema.names, "ends"])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        vocabulary = loaded(shared.value, pattern)
        copies = int((frame["start"] == 0).sum())
        frame = frame.drop_duplicates("start").sort_values("start")
        pieces = list(zip(frame["start"], frame["part"], frame["ends"]))
        text = "".join(p[: chunk if i + 1 < len(pieces) else None] for i, (_, p, _) in enumerate(pieces))
        ends = stitch(vocabulary.find, text, [(s, s + len(p), np.asarray(e)) for s, p, e in pieces])
        ids = vocabulary.encode_pieces([_pieces(text, ends)])[0]
        return pd.DataFrame({"key": [frame["key"].iloc[0]] * copies, "ids": [ids] * copies})

    short = rows.where(F.length("text") <= chunk).mapInArrow(tidy(whole), f"key {kind}, ids array<int>")
    starts = F.sequence(F.lit(0), F.length("text") - 1, F.lit(chunk))
    long = (
        rows.where(F.length("text") > chunk)
        .select("key", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), "text",
                F.explode(starts).alias("start"))
        .select("key", "h1", "h2", "start",
                F.expr(f"substring(text, start + 1, {chunk + overlap})").alias("part"))
        .repartition("key", "h1", "start")
        .mapInArrow(tidy(chunks), f"key {kind}, h1 bigint, h2 int, start int, part string, ends array<bigint>")
        .groupBy("key", "h1", "h2")
        .applyInPandas(joined, f"key {kind}, ids array<int>")
    )
    return short.unionByName(long).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def joined(column: pd.Series) -> pd.Series:
        find = spelled(shared.value).__getitem__
        return column.map(lambda x: b"" if x is None else b"".join(map(find, np.asarray(x).tolist())))

    return encoded.withColumn(into, joined(ids))
