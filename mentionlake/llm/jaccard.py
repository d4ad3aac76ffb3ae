"""N-gram Jaccard join with signature trees: exact links and their components.

A text's set holds 64-bit hashes of its distinct shingles of ``width`` words; texts with equal sets are
one class. Sets that overlap enough share one of their first tokens in any common order of tokens
(prefix filter), so each token is the root of a tree over the classes that have it among their first;
the order goes by counts of all texts in a table of fixed size, so tokens that many texts have come last.

Nodes of a tree hold the bitwise or of their classes' token bitmaps and the range of their sizes; leaves
hold classes of like size. The two sides of a tree are traversed together, and a pair of nodes is dropped
as soon as the overlap that sizes and bitmaps allow is too small, or if both are one component already.
``ROUNDS`` rounds first try every class against ``TRIED`` of about ``HUBS`` classes of each tree, the same ones for
all near copies, so that groups of these, however large, are mostly one component before their trees are traversed.
A tree of up to ``HUBS`` classes is a single leaf, whose pairs across components are all looked at. A tree of n
classes is dealt into pairs of blocks of about ``BLOCK``, so no
group is larger than two blocks. The bitmaps of its nodes are wide, so near copies that are too far apart to link are
seldom taken for links. Surviving pairs are decided by their sets. Links inside one component may
stay untested, links between components never.

Texts that are null, empty or without words have empty sets and link with nothing, like rows without a
key (component null). Repeated rows stay repeated; of several texts of one key each counts. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from mentionlake.llm.common import components, ready, texts, tidy
from mentionlake.llm.words import SPACES, hash_words, mix
from mentionlake.session import materialize, small_side

COUNTERS = 1 << 18  # of the table of token counts
CHUNK = 1 << 12  # counters in one row of it
PARTS = 256  # groups in which counts of tasks are added first
BLOCK = 512  # classes of a block
NARROW, WIDE = 2, 8  # least bits for each token, of pairs that are tried and of trees
LEAF = 16
FAN = 4
HUBS = 16  # most classes of a tree, at least half as many, that others are tried against in a round
TRIED = 4  # pairs of a class in a round
ROUNDS = 2
BROADCAST_KEYS = 1_000_000  # 16 MB
BROADCAST_NUMBERS = 4_000_000  # of rows; 64 MB


def shingle_sets(rows: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle."""
    hashes, counts = hash_words(rows, SPACES)
    ends = np.cumsum(counts)
    out = []
    with np.errstate(over="ignore"):
        joined = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for i in range(width):
            joined = mix(joined ^ hashes[i : i + len(joined)])
        for end, n in zip(ends.tolist(), counts.tolist()):
            if n >= width:
                out.append(np.unique(joined[end - n : end - width + 1]))
            elif n:
                one = np.zeros(1, np.uint64)
                for h in hashes[end - n : end]:
                    one = mix(one ^ h)
                out.append(mix(one ^ np.uint64(n)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def counter(tokens: np.ndarray) -> np.ndarray:
    """Counter of each token."""
    return (tokens >> np.uint64(46)).astype(np.int64)


def bit_count(n: int, per_token: int = NARROW) -> int:
    """Bits of the bitmap of a set of ``n`` tokens."""
    return 1 << max(6, int(per_token * n - 1).bit_length())


def bitmap(tokens: np.ndarray, per_token: int = NARROW) -> bytes:
    bits = np.zeros(bit_count(len(tokens), per_token), np.uint8)
    bits[(tokens & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def digest(tokens: np.ndarray) -> int:
    """One number for a set."""
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(tokens))]))[0].astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _counts(width: int):
    """Counts of the tokens of a partition, in rows of ``CHUNK`` counters."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for _, part in texts(batches, 0):
            tokens = np.concatenate(shingle_sets(part, width))
            counts += np.bincount(counter(tokens), minlength=COUNTERS)
        if counts.any():
            chunks = counts.reshape(-1, CHUNK)
            part = np.full(len(chunks), TaskContext.get().partitionId() % PARTS, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(chunks), dtype=np.int32)), pa.array(part),
                 pa.array([c.tobytes() for c in chunks], pa.binary())],
                ["chunk", "part", "counts"],
            )

    return run


def _added(frame):
    total = np.zeros(CHUNK, np.int64)
    for c in frame["counts"]:
        total += np.frombuffer(c, np.int64)
    return frame.head(1).assign(counts=[total.tobytes()])


def token_counts(rows: DataFrame, width: int) -> np.ndarray:
    """The count of each counter. Counts cover every text; their table is of fixed size."""
    schema = "chunk int, part int, counts binary"
    chunks = (
        rows.select("text").mapInArrow(tidy(_counts(width)), schema)
        .groupBy("chunk", "part").applyInPandas(_added, schema)
        .groupBy("chunk").applyInPandas(_added, schema)
        .collect()
    )
    counts = np.zeros((COUNTERS // CHUNK, CHUNK), np.int64)
    for row in chunks:
        counts[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    return counts.ravel()


def _described(width: int, percent: int, shared):
    """Size, class, first tokens and bitmaps of each text, and the number of its row."""

    def run(batches):
        counts = shared.value
        for batch, part in texts(batches):
            size, kind, first, bits, wide = [], [], [], [], []
            for tokens in shingle_sets(part, width):
                n = len(tokens)
                keep = prefix_length(n, percent) if n else 0
                rarest = np.argsort(counts[counter(tokens)], kind="stable")[:keep]
                size.append(n)
                kind.append(digest(tokens) if n else None)
                first.append(tokens[rarest].astype(np.int64))
                bits.append(bitmap(tokens) if n else b"")
                wide.append(bitmap(tokens, WIDE) if n else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int32()), pa.array(kind, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                 pa.array(wide, pa.binary()), batch.column(2)],
                ["key", "n", "class", "first", "bits", "wide", "row"],
            )

    return run


def _classes(width: int):
    """(key, text, class) of texts."""

    def run(batches):
        for batch, part in texts(batches):
            kind = [digest(tokens) if len(tokens) else None for tokens in shingle_sets(part, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kind, pa.int64())], ["key", "text", "class"])

    return run


def _sets(width: int):
    """(class, tokens) of texts whose set is the one that is looked for."""

    def run(batches):
        for batch, part in texts(batches):
            sets = shingle_sets(part, width)
            wanted = batch.column(0).to_pylist()
            hit = [i for i, s in enumerate(sets) if len(s) and digest(s) == wanted[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([wanted[i] for i in hit], pa.int64()), pa.array([sets[i].tobytes() for i in hit], pa.binary())],
                ["class", "tokens"],
            )

    return run


def _decided(percent: int):
    def run(batches):
        for batch in batches:
            sets = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("x", "y")]
            keep = []
            for x, y in zip(*sets):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _words(bits: bytes, width: int) -> np.ndarray:
    """A bitmap folded to ``width`` bits, as 64-bit words."""
    x = np.frombuffer(bits, np.uint64)
    return np.bitwise_or.reduce(x.reshape(-1, width // 64), axis=0)


def near(n: int, x: bytes, m: int, y: bytes, percent: int) -> bool:
    """Whether sizes and bitmaps of two sets allow them to overlap enough."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    width = 8 * min(len(x), len(y))
    p, q = _words(x, width), _words(y, width)
    spare = min(n - int(np.bitwise_count(p).sum()), m - int(np.bitwise_count(q).sum()))
    most = min(n, m, int(np.bitwise_count(p & q).sum()) + spare)
    return (100 + percent) * most >= percent * (n + m)


class Tree:
    """Signature tree over classes of one block: leaves of up to ``LEAF`` classes of like size, nodes of ``FAN`` children."""

    def __init__(self, ids, sizes, groups, bits):
        _, back, count = np.unique(groups, return_inverse=True, return_counts=True)
        own = np.where(count[back] >= LEAF, back, -1)  # components with leaves of their own
        width = np.array([len(x) for x in bits])
        order = np.lexsort((sizes, own))
        self.ids, self.sizes, self.groups = ids[order], sizes[order], groups[order]
        self.bits = [bits[i] for i in order]
        runs = np.flatnonzero(np.r_[True, (np.diff(own[order]) != 0) | (np.diff(width[order]) != 0), True]).tolist()
        cuts = [(a, min(a + LEAF, end)) for start, end in zip(runs, runs[1:]) for a in range(start, end, LEAF)]
        self.levels = [[self._leaf(a, b) for a, b in cuts]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._node(below[a : a + FAN], a, min(a + FAN, len(below))) for a in range(0, len(below), FAN)])

    def _leaf(self, a: int, b: int) -> dict:
        width = 8 * min(len(x) for x in self.bits[a:b])
        words = np.stack([_words(x, width) for x in self.bits[a:b]])
        spare = self.sizes[a:b] - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        group = self.groups[a] if (self.groups[a:b] == self.groups[a]).all() else None
        return {"at": (a, b), "width": width, "words": words, "or": np.bitwise_or.reduce(words, axis=0),
                "spare": int(spare.max()), "low": int(self.sizes[a:b].min()), "high": int(self.sizes[a:b].max()), "group": group}

    @staticmethod
    def _node(children: list[dict], a: int, b: int) -> dict:
        width = min(c["width"] for c in children)
        folded = [np.bitwise_or.reduce(c["or"].reshape(-1, width // 64), axis=0) for c in children]
        # tokens that share a bit after folding are not counted by it; bound them by the largest set
        spare = max(c["spare"] if c["width"] == width else c["high"] for c in children)
        groups = {c["group"] for c in children}
        return {"at": (a, b), "width": width, "or": np.bitwise_or.reduce(np.stack(folded), axis=0), "spare": spare,
                "low": min(c["low"] for c in children), "high": max(c["high"] for c in children),
                "group": groups.pop() if len(groups) == 1 else None}


def possible(x: dict, y: dict, percent: int) -> bool:
    """Whether some class below ``x`` and some below ``y`` of another component may overlap enough."""
    if x["group"] is not None and x["group"] == y["group"]:
        return False
    if 100 * x["high"] < percent * y["low"] or 100 * y["high"] < percent * x["low"]:
        return False
    width = min(x["width"], y["width"])
    both = _words(x["or"].tobytes(), width) & _words(y["or"].tobytes(), width)
    spare = min(v["spare"] if v["width"] == width else v["high"] for v in (x, y))
    most = min(x["high"], y["high"], int(np.bitwise_count(both).sum()) + spare)
    return (100 + percent) * most >= percent * (x["low"] + y["low"])


def _leaf_pairs(s: Tree, x: dict, t: Tree, y: dict, percent: int) -> list[tuple[int, int]]:
    (a, b), (c, d) = x["at"], y["at"]
    width = min(x["width"], y["width"])
    p = np.bitwise_or.reduce(x["words"].reshape(b - a, -1, width // 64), axis=1)
    q = np.bitwise_or.reduce(y["words"].reshape(d - c, -1, width // 64), axis=1)
    n, m = s.sizes[a:b], t.sizes[c:d]
    both = np.bitwise_count(p[:, None, :] & q[None, :, :]).sum(axis=2, dtype=np.int64)
    spare = np.minimum((n - np.bitwise_count(p).sum(axis=1, dtype=np.int64))[:, None], (m - np.bitwise_count(q).sum(axis=1, dtype=np.int64))[None])
    small, large = np.minimum(n[:, None], m[None]), np.maximum(n[:, None], m[None])
    fit = (100 + percent) * np.minimum(small, both + spare) >= percent * (small + large)
    fit &= (100 * small >= percent * large) & (s.groups[a:b, None] != t.groups[None, c:d])
    return [(int(s.ids[a + i]), int(t.ids[c + j])) for i, j in zip(*np.nonzero(fit))]


def traverse(s: Tree, t: Tree, percent: int) -> set[tuple[int, int]]:
    """Pairs of classes that two trees (or one tree with itself) may link, across components."""
    found: set[tuple[int, int]] = set()
    stack = [(len(s.levels) - 1, 0, len(t.levels) - 1, 0)]
    while stack:
        i, x, j, y = stack.pop()
        if s is t and i == j and x > y:
            continue
        left, right = s.levels[i][x], t.levels[j][y]
        if not possible(left, right, percent):
            continue
        if i == j == 0:
            found |= {(min(p), max(p)) for p in _leaf_pairs(s, left, t, right, percent) if p[0] != p[1]}
        elif s is t:  # both sides go down together
            stack += [(i - 1, u, j - 1, v) for u in range(*left["at"]) for v in range(*right["at"])]
        elif i >= j:
            stack += [(i - 1, u, j, y) for u in range(*left["at"])]
        else:
            stack += [(i, x, j - 1, v) for v in range(*right["at"])]
    return found


def _traversed(percent: int):
    """Candidate pairs of the groups (place, token) of a partition that is sorted by them."""

    def finish(rows: list[tuple]) -> set[tuple[int, int]]:
        low, high = rows[0][2:4]
        trees = []
        for block in dict.fromkeys((low, high)):
            own = [r for r in rows if r[5] == block]
            if own:
                ids, sizes, groups = (np.array([r[k] for r in own], np.int64) for k in (6, 7, 8))
                trees.append(Tree(ids, sizes, groups, [r[9] for r in own]))
        if low == high:
            return traverse(trees[0], trees[0], percent)
        return traverse(*trees, percent) if len(trees) == 2 else set()

    def run(batches):
        group: list[tuple] = []
        found: set[tuple[int, int]] = set()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:5] != group[0][:5]:
                    found |= finish(group)
                    if row[:4] != group[0][:4] and len(found) > 10_000:
                        yield _pairs(found)
                        found = set()
                    group = []
                group.append(row)
        if group:
            found |= finish(group)
        yield _pairs(found)

    return run


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    ordered = sorted(found)
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in ordered], pa.int64()) for i in (0, 1)], ["a", "b"])


class Join:
    """The classes of a table and how pairs of them are decided."""

    def __init__(self, docs: DataFrame, key: str, text: str, width: int, percent: int):
        spark = ready(docs.sparkSession)
        self.width, self.percent = width, percent
        self.rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        kind = docs.schema[key].dataType.simpleString()
        shared = spark.sparkContext.broadcast(token_counts(self.rows, width))
        self.described = materialize(
            self.rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
                tidy(_described(width, percent, shared)), f"key {kind}, n int, class bigint, first array<bigint>, bits binary, wide binary, row bigint"),
            "described",
        )
        members = self.described.where("class is not null and key is not null")
        classes = materialize(
            members.groupBy("class").agg(F.min(F.struct("key", "row")).alias("least"), F.count("*").alias("texts")), "classes")
        self.classes = classes.select("class", F.col("least.key").alias("holder"))
        # tokens and bitmaps stay where they lie: only the numbers of rows that repeat a class are sent around
        repeated = classes.where("texts > 1").select("class", F.col("least.row").alias("held"))
        again = materialize(members.select("class", "row").join(repeated, "class").where("row <> held").select("row"), "again")
        self.once = members.join(small_side(again, again.count(), BROADCAST_NUMBERS), "row", "left_anti")
        # an entry stays if the next smaller or larger class of its tree is near enough in size
        tree = Window.partitionBy("token")
        by_size = tree.orderBy("n")
        self.entries = materialize(
            self.once.select(F.explode("first").alias("token"), "class", "n")
            .withColumn("smaller", F.lag("n").over(by_size)).withColumn("larger", F.lead("n").over(by_size))
            .where(f"100 * smaller >= {percent} * n or 100 * n >= {percent} * larger")
            .select("token", "class", "n", F.count("*").over(tree).alias("size")),
            "entries",
        )
        grown = self.entries.select("class").distinct()
        self.bitmaps = materialize(self.once.select("class", "n", "bits").join(grown, "class"), "bitmaps")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose sets overlap enough."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        wanted = materialize(ends.join(self.classes, "class").select("class", F.col("holder").alias("key")), "wanted")
        holders = small_side(wanted, wanted.count(), BROADCAST_KEYS)
        sets = materialize(
            self.rows.join(holders, "key").select("class", "text").mapInArrow(tidy(_sets(self.width)), "class bigint, tokens binary")
            .dropDuplicates(["class"]),
            "sets",
        )
        x, y = (sets.select(F.col("class").alias(c), F.col("tokens").alias(n)) for c, n in (("a", "x"), ("b", "y")))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(tidy(_decided(self.percent)), "a bigint, b bigint")

    def open_trees(self, reached: DataFrame | None) -> DataFrame:
        """Entries, with components so far, of trees that hold more than one component."""
        if reached is None:
            return self.entries.withColumn("component", F.col("class"))
        known = self.entries.join(reached.withColumnRenamed("vertex", "class"), "class", "left")
        known = known.withColumn("component", F.coalesce("component", "class"))
        tree = Window.partitionBy("token")
        ends = known.withColumn("p", F.min("component").over(tree)).withColumn("q", F.max("component").over(tree))
        return ends.where("p <> q").drop("p", "q")

    def fit(self) -> str:
        """Whether sizes and components of a class and a ``hub`` allow a link that is not known."""
        return f"100 * least(n, hub.n) >= {self.percent} * greatest(n, hub.n) and component <> hub.component"

    def tries(self, entries: DataFrame, salt: int) -> DataFrame:
        """Pairs of every class with ``TRIED`` of about ``HUBS`` classes of each of its trees, if sizes and bitmaps allow a link."""
        # hubs of a tree are hubs of the smaller trees that hold them, and come first there: near copies, which
        # share most trees, are tried against the same few classes
        turn = F.shiftrightunsigned(F.xxhash64("class", F.lit(salt)), 11) / F.lit(float(1 << 53))
        hubs = entries.withColumn("turn", turn).where(
            F.col("turn") * F.expr("power(2, ceil(log2(size)))") < HUBS
        ).select("token", F.struct("class", "n", "component").alias("hub"), "turn")
        met = entries.join(hubs, "token").where(self.fit()).select("class", F.col("hub.class").alias("other"), "turn").distinct()
        first = Window.partitionBy("class").orderBy("turn", "other")
        tried = met.withColumn("place", F.row_number().over(first)).where(F.col("place") <= TRIED)
        return self.bounded(tried.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct())

    def leaves(self, entries: DataFrame) -> DataFrame:
        """All pairs of trees of up to ``HUBS`` classes, across components, if sizes and bitmaps allow a link."""
        hubs = entries.select("token", F.struct("class", "n", "component").alias("hub"))
        met = entries.join(hubs, "token").where(f"class < hub.class and {self.fit()}")
        return self.bounded(met.select(F.col("class").alias("a"), F.col("hub.class").alias("b")).distinct())

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose bitmaps allow a link."""
        x, y = (self.bitmaps.select(F.col("class").alias(c), F.col("bits").alias(n), F.col("n").alias(m))
                for c, n, m in (("a", "x", "n"), ("b", "y", "m")))
        percent = self.percent

        def run(batches):
            for batch in batches:
                sides = zip(*(batch.column(c).to_pylist() for c in ("n", "x", "m", "y")))
                keep = [near(*pair, percent) for pair in sides]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(tidy(run), "a bigint, b bigint")

    def descents(self, entries: DataFrame) -> DataFrame:
        """Pairs that traversing the trees of ``entries`` leaves."""
        least = entries.groupBy("token").agg(F.min("class").alias("least"))
        needed = materialize(entries.select("class").distinct(), "needed")
        wide = self.once.select("class", F.col("wide").alias("bits")).join(
            small_side(needed, needed.count(), BROADCAST_NUMBERS), "class")
        dealt = (
            entries.join(least, "token")
            .withColumn("blocks", F.expr(f"int(power(2, ceil(log2(greatest(1.0D, size / {BLOCK}D)))))"))
            .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .join(wide, "class")
            .select("least", "blocks", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "token", "block", "class", "n", "component", "bits")
        )
        # the same blocks of like trees meet in one task, which gives each of their pairs once
        place = ["least", "blocks", "low", "high"]
        traversed = (
            dealt.repartition(*place).sortWithinPartitions(*place, "token")
            .mapInArrow(tidy(_traversed(self.percent)), "a bigint, b bigint")
        )
        return traversed.distinct()


def classed(docs: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """(key, n, class, component, component_id) of every row; class and component are null without words or key of its set.

    ``component`` is a number of its own for each component, ``component_id`` its smallest key, which rows of
    several components may share if they share the key.
    """
    work = Join(docs, key, text, width, percent)
    reached, edges = None, None
    for salt in range(ROUNDS + 1):
        entries = work.open_trees(reached)
        entries = entries if reached is None else materialize(entries, "open-trees")
        if salt < ROUNDS:
            pairs = work.tries(entries, salt)
        else:
            small = F.col("size") <= HUBS
            pairs = work.leaves(entries.where(small)).unionByName(work.descents(entries.where(~small))).distinct()
        new = materialize(work.links(materialize(pairs, "pairs")), "edges")
        edges = new if edges is None else edges.unionByName(new)
        reached = components(edges, "classes-reached")
    lowest = (
        work.classes.join(reached.withColumnRenamed("vertex", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = lowest.groupBy("component").agg(F.min("holder").alias("component_id"))
    of_class = lowest.join(smallest, "component").select("class", "component", "component_id")
    return work.described.select("key", "n", "class").join(of_class, "class", "left")


def join(docs: DataFrame, width: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row: sets link from ``percent`` / 100 Jaccard similarity."""
    return classed(docs, width, percent, key, text).select(
        F.col("key").alias(key),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest key of each component; rows without a key or words stay.

    Of several texts of that key in one component the least stays; of one key, texts of different components are
    decided each by its own. Only the keys that go, and rows whose key repeats, are joined. Repeats of one row
    count once.
    """
    names = ["__gone", "__twice", "__key", "__text"]
    while set(names) & set(docs.columns):  # columns may be called anything
        names = [f"_{n}" for n in names]
    gone_key, twice_key, own_key, own_text = names
    found = materialize(classed(docs, width, percent, key, text).where("key is not null"), "classed")
    twice = materialize(found.groupBy(F.col("key").alias(twice_key)).agg(F.count("*").alias("__n")).where("__n > 1").select(twice_key), "twice")
    repeated = twice.count()
    gone = found.where("key <> component_id").select(F.col("key").alias(gone_key)).distinct()
    if repeated:
        twice = small_side(twice, repeated, BROADCAST_KEYS)
        gone = gone.join(twice, F.col(gone_key) == F.col(twice_key), "left_anti")
    gone = materialize(gone, "gone")
    kept = docs.join(small_side(gone, gone.count(), BROADCAST_KEYS), F.col(key) == F.col(gone_key), "left_anti")
    if not repeated:
        return kept
    same = F.col(key) == F.col(twice_key)
    again = docs.join(twice, same, "left_semi")
    kind = docs.schema[key].dataType.simpleString()
    pairs = again.select(F.col(key).alias("key"), F.col(text).alias("text")).distinct().mapInArrow(tidy(_classes(width)), f"key {kind}, text string, class bigint")
    verdicts = found.join(twice, F.col("key") == F.col(twice_key), "left_semi").where("class is not null").select("key", "class", "component", "component_id").distinct()
    judged = pairs.join(verdicts, ["key", "class"], "left").where("class is null or key = component_id")
    # one text of each component; texts without words are repeats only of themselves
    stay = (
        judged.groupBy("key", "component", F.when(F.col("class").isNull(), F.struct(F.col("text").alias("t"))).alias("__own"))
        .agg(F.min("text").alias("text")).select(F.col("key").alias(own_key), F.col("text").alias(own_text))
    )
    once = again.dropDuplicates([key, text]).join(
        stay, (F.col(key) == F.col(own_key)) & F.col(text).eqNullSafe(F.col(own_text)), "left_semi")
    return kept.join(twice, same, "left_anti").unionByName(once)
