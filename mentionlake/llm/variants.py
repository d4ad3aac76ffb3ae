"""Spelling variants by a frequency-vector trie.

Words are arranged by how many letters they have of each of ``GROUPS``, group after group, so a node of
the trie holds the words with the same first counts. One edit changes these counts by at most one surplus
and one deficit: an inserted letter is a surplus, a deleted one a deficit, a replaced one both or, within a
group, neither. A search descends with a budget of one each and spends it where the counts of a child
differ from its own; words at the leaves it arrives at are compared letter by letter.

Each pair of near words is sought from one side only: from the shorter word, or from the one with more
letters of the first group that differs (within one leaf from the smaller word). The trie is cut below its
first ``depth`` groups: every subtree is built in one place, and each word visits its own subtree and those
its budget reaches. Depth follows from the number of words; a subtree of more than ``SLAB`` words is dealt
into slabs that each of its visitors sees. A task holds one slab and streams the visitors, and gives per
word only counts and the best near word. Nothing is capped.

Texts that are null have no words. Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with only A-Z
lower-cased; runs of any length count whole. A missing key counts as an empty text in the hash. Rows of
one key each count. Further columns are ignored. No words give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.llm.common import batch_rows, meet, ready
from mentionlake.session import materialize, small_side

# letters in the order of the trie's levels; everything else is the last group
GROUPS = ("e", "a", "i", "n", "o", "t", "r", "s", "u", "l", "dh", "cm", "pgb", "fvwy", "jkqxz")
SUBTREE = 20_000  # words of a subtree, on average, that depth is chosen for
BRANCHES = 2.5  # subtrees of a level for each of the level above, about
SLAB = 100_000  # words of a trie
VISITORS = 4096  # that descend at a time
PAIRS = 1 << 16  # that are compared at a time
WIDE = 48  # longer words are compared one by one

LEVELS = len(GROUPS) + 1
GROUP_OF = np.full(256, len(GROUPS), np.int64)
for _g, _letters in enumerate(GROUPS):
    GROUP_OF[[ord(c) for c in _letters]] = _g
# a subtree's number is the sum of count times factor over its groups, modulo 2**64
FACTORS = np.random.default_rng(11).integers(1, 1 << 62, LEVELS, dtype=np.int64) * 2 + 1

NEAR = "word string, near bigint, best struct<less bigint, form string>"


def words(docs: DataFrame, least_letters: int = 5, least_count: int = 3, one_in: int = 97,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words that occur often enough, after one of ``one_in`` runs has lost a letter."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    run = F.explode(F.regexp_extract_all(F.translate(text, capitals, small), F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1)))
    prefix = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"))
    h = F.crc32(F.concat("prefix", "run").cast("binary"))
    at = F.expr("cast(h % length(run) as int)")
    word = F.when(F.col("h") % one_in != 0, F.col("run")).otherwise(
        F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.length("run"))))
    return (
        docs.select(prefix.alias("prefix"), run.alias("run"))
        .where(F.length("run") >= least_letters)
        .withColumn("h", h).select(word.alias("word"))
        .where(F.length("word") >= least_letters)
        .groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )


def counts_of(raw: list[bytes]) -> np.ndarray:
    """Letters of each group in each word."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    row = np.repeat(np.arange(len(raw)), [len(w) for w in raw])
    return np.bincount(row * LEVELS + GROUP_OF[data], minlength=len(raw) * LEVELS).reshape(-1, LEVELS)


def _encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def steps(depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(change of the subtree's number, whether only words of equal length can be near) of each visit.

    The own subtree, one with a surplus in the first groups, and one with a surplus in one group and a
    deficit in a later one: the other ways round are visits of the other word.
    """
    own = [(0, False)]
    more = [(int(FACTORS[i]), False) for i in range(depth)]
    both = [(int(FACTORS[i]) - int(FACTORS[j]), True) for i in range(depth) for j in range(i + 1, depth)]
    moves = own + more + both
    return np.array([m for m, _ in moves], np.int64), np.array([e for _, e in moves])


def _homes(depth: int):
    """The subtree of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = counts_of(_encoded(batch.column(0)))[:, :depth] @ FACTORS[:depth]
                yield pa.RecordBatch.from_arrays([pa.array(home)], ["tree"])

    return run


def _dealt(depth: int):
    """Each word at its own subtree (role 0), and as a visitor (role 1) of all it may reach."""
    moves, _ = steps(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = batch.num_rows, len(moves)
            home = counts_of(_encoded(batch.column(0)))[:, :depth] @ FACTORS[:depth]
            rows = pa.array(np.r_[np.arange(n), np.repeat(np.arange(n), m)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[home, (home[:, None] + moves).ravel()]), pa.array(np.repeat([0, 1], [n, n * m]).astype(np.int32)),
                 pa.array(np.r_[np.zeros(n), np.tile(np.arange(m), n)].astype(np.int32)), *batch.take(rows).columns],
                ["tree", "role", "move", "word", "n"])

    return run


def _padded(raw: list[bytes]) -> np.ndarray:
    """Letters of words of up to ``WIDE`` letters, one row each; longer words are cut and not compared here."""
    return np.array(raw, f"S{WIDE}").view(np.uint8).reshape(len(raw), WIDE)


def near(u: np.ndarray, v: np.ndarray, lengths: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether each v is u with one letter replaced or, where ``longer``, inserted."""
    width = int(lengths.max(initial=0)) + 1
    u, v = u[:, :width], v[:, :width]
    differ = u != v
    replaced = differ.sum(axis=1) == 1
    first = differ.argmax(axis=1)
    columns = np.arange(width - 1)
    shifted = (u[:, :-1] != v[:, 1:]) & (columns >= first[:, None]) & (columns < lengths[:, None])
    return np.where(longer, ~shifted.any(axis=1), replaced)


def near_long(u: bytes, v: bytes) -> bool:
    """The same for words of any length."""
    same = next((i for i, (a, b) in enumerate(zip(u, v)) if a != b), len(u))
    if len(v) == len(u):
        return same < len(u) and u[same + 1 :] == v[same + 1 :]
    return len(v) == len(u) + 1 and u[same:] == v[same + 1 :]


class Trie:
    """Words of a subtree in order of their count vectors; nodes are ranges of them, level by level."""

    def __init__(self, rows: pa.Table):
        raw = _encoded(rows["word"])
        counts = counts_of(raw)
        order = np.lexsort(counts.T[::-1])
        self.raw = [raw[i] for i in order]
        self.n = rows["n"].to_numpy()[order]
        self.letters = _padded(self.raw)
        self.sizes = np.array([len(w) for w in self.raw])
        self.rank = np.argsort(np.argsort(np.array(self.raw, object), kind="stable"), kind="stable")
        counts = counts[order]
        node = np.zeros(len(raw), np.int64)
        self.most = int(counts.max())
        self.width = self.most + 3  # slots of a node: counts from -1 to one more than any word has
        self.keys = []
        for level in range(LEVELS):
            keys = node * self.width + counts[:, level] + 1
            fresh = np.r_[True, keys[1:] != keys[:-1]]
            self.keys.append(keys[fresh])
            node = np.cumsum(fresh) - 1
        self.starts = np.r_[np.flatnonzero(fresh), len(raw)]

    def descend(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(visitor, leaf, surplus, deficit) of every leaf that the budget reaches."""
        at, node = np.arange(len(counts)), np.zeros(len(counts), np.int64)
        more, less = np.zeros(len(counts), bool), np.zeros(len(counts), bool)
        for level, keys in enumerate(self.keys):
            own = counts[at, level]
            held = own <= self.most + 1
            branches = [np.flatnonzero(held), np.flatnonzero(held & ~more), np.flatnonzero(held & ~less)]
            source = np.concatenate(branches)
            change = np.repeat([0, 1, -1], [len(b) for b in branches])
            sought = node[source] * self.width + own[source] + 1 + change
            place = np.searchsorted(keys, sought)
            hit = keys[np.minimum(place, len(keys) - 1)] == sought
            source, change, node = source[hit], change[hit], place[hit]
            at, more, less = at[source], more[source] | (change == 1), less[source] | (change == -1)
        fits = more | ~less  # a lone deficit is the other word's visit
        return at[fits], node[fits], more[fits], less[fits]


def _best(own: np.ndarray, other_n: np.ndarray, other_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, how many pairs, the pair with the most frequent and then smallest other word)."""
    order = np.lexsort((other_rank, -other_n, own))
    first = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]])
    return own[order][first], np.diff(np.r_[first, len(own)]), order[first]


def _batch(words: list[bytes], near: np.ndarray, n: np.ndarray, forms: list[bytes]) -> pa.RecordBatch:
    best = pa.StructArray.from_arrays(
        [pa.array(-n), pa.array([w.decode("latin-1") for w in forms], pa.string())], ["less", "form"])
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array(near.astype(np.int64)), best], ["word", "near", "best"])


def _visits(depth: int):
    _, equal_only = steps(depth)

    def visit(trie: Trie, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, n = _encoded(rows.column("word")), rows.column("n").to_numpy()
        move = rows.column("move").to_numpy()
        counts, sizes, letters = counts_of(raw), np.array([len(w) for w in raw]), _padded(raw)
        rank = np.argsort(np.argsort(np.array(raw, object), kind="stable"), kind="stable")
        us, vs = [], []
        for at in range(0, len(raw), VISITORS):
            visitor, leaf, more, less = trie.descend(counts[at : at + VISITORS])
            visitor += at
            fits = (more == less) | ~equal_only[move[visitor]]
            visitor, leaf = visitor[fits], leaf[fits]
            held = trie.starts[leaf + 1] - trie.starts[leaf]
            ends = np.cumsum(held)
            start = 0
            while start < len(visitor):  # as many leaves at a time as hold about PAIRS words
                end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
                part = slice(start, end)
                first = np.repeat(trie.starts[leaf[part]] - (ends[part] - held[part]), held[part])
                v = first + np.arange(ends[part][0] - held[part][0], ends[part][-1])
                u = np.repeat(visitor[part], held[part])
                found = _near_pairs(trie, raw, letters, sizes, move, u, v)
                us.append(u[found])
                vs.append(v[found])
                start = end
        if not us:
            return
        u, v = np.concatenate(us), np.concatenate(vs)
        if len(u):
            own, count, pair = _best(u, trie.n[v], trie.rank[v])
            yield _batch([raw[i] for i in own], count, trie.n[v[pair]], [trie.raw[i] for i in v[pair]])
            own, count, pair = _best(v, n[u], rank[u])
            yield _batch([trie.raw[i] for i in own], count, n[u[pair]], [raw[i] for i in u[pair]])

    def run(batches):
        yield from meet(batches, ["tree", "slab"], Trie, visit)

    return run


def _near_pairs(trie: Trie, raw: list[bytes], letters: np.ndarray, sizes: np.ndarray, move: np.ndarray,
               u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which pairs of a visitor and a word of the trie are near, and this visitor's to find."""
    longer = trie.sizes[v] - sizes[u]
    out = (longer == 0) | (longer == 1)
    wide = out & (trie.sizes[v] > WIDE)
    short = np.flatnonzero(out & ~wide)
    a, b = u[short], v[short]
    out[short] = near(letters[a], trie.letters[b], sizes[a], longer[short] == 1)
    for i in np.flatnonzero(wide):
        out[i] = near_long(raw[u[i]], trie.raw[v[i]])
    # in the own subtree both words of equal length visit: the smaller one counts
    for i in np.flatnonzero(out & (longer == 0) & (move[u] == 0)):
        out[i] = raw[u[i]] < trie.raw[v[i]]
    return out


def near_words(known: DataFrame, depth: int | None = None) -> DataFrame:
    """(word, near, less, form): how many words are one edit away, and the most frequent of them.

    ``known`` has distinct words and their counts n, and is read three times. ``less`` is -n of the form.
    """
    spark = ready(known.sparkSession)
    known = known.select("word", F.col("n").cast("bigint").alias("n"))
    total = known.count()
    if depth is None:
        depth = min(max(2, math.ceil(math.log(max(total, 1) / SUBTREE, BRANCHES))), LEVELS)
    with batch_rows(spark, 20_000):
        sizes = known.select("word").mapInArrow(_homes(depth), "tree bigint").groupBy("tree").count()
        large = materialize(
            sizes.where(F.col("count") > SLAB).select("tree", F.ceil(F.col("count") / SLAB).cast("int").alias("slabs")), "large-subtrees")
    dealt = known.mapInArrow(_dealt(depth), "tree bigint, role int, move int, word string, n bigint")
    split = dealt.join(small_side(large, total // SLAB), "tree", "left").withColumn("slabs", F.coalesce("slabs", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("word"), F.col("slabs")).cast("int"))
    slab = F.explode(F.when(F.col("role") == 0, own).otherwise(F.sequence(F.lit(0), F.col("slabs") - 1)))
    placed = split.withColumn("slab", slab).select("tree", "slab", "role", "move", "word", "n")
    with batch_rows(spark, 20_000):
        found = materialize(
            placed.repartition("tree", "slab").sortWithinPartitions("tree", "slab", "role").mapInArrow(_visits(depth), NEAR), "near-words")
    return found.groupBy("word").agg(F.sum("near").alias("near"), F.min("best").alias("best")).select("word", "near", "best.*")


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of words with a form, by doubling steps: after r rounds 2**r forms have been followed."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        onward = at.select(F.col("word").alias("via"), F.col("root").alias("next"))
        at = materialize(
            at.join(onward, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return at


def group(known: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``known`` (word, n).

    A word's form is its most frequent near word (ties: the smallest), if that is at least ``ratio`` times
    as frequent; its root is where following forms ends.
    """
    known = materialize(known, "known-words")
    near = near_words(known)
    often = -F.col("less") >= ratio * F.col("n")
    rows = materialize(known.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("form")).alias("form"), F.when(often, -F.col("less")).alias("form_n")), "forms")
    # along forms counts grow by ratio, so chains are no longer than the logarithm of the largest count
    most = rows.agg(F.max("n"), F.min("n")).first()
    longest = math.log((most[0] or 1) / max(most[1] or 1, 1), ratio) + 1 if ratio > 1 else most[0] or 1
    followed = roots(rows.where("form IS NOT NULL"), math.ceil(math.log2(max(longest, 1))) + 1)
    return rows.join(followed, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _nibble_table() -> list[int]:
    """Remainders of the 16 half bytes by the polynomial of crc32."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS p, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
distinct_runs AS (SELECT run, count(*) AS c, hex(encode(p || run)) AS b FROM runs WHERE length(run) >= 5 GROUP BY p, run),
hashed AS (SELECT run, c, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), [CAST('0x' || substr(b, i + 1 - 2 * (i % 2) + 1, 1) AS BIGINT) FOR i IN range(length(b))]),
    lambda a, d: xor(a >> 4, {_nibble_table()}[(xor(a, d) & 15) + 1])), 4294967295) AS h FROM distinct_runs),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 97 <> 0 THEN run
      ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
found AS (
  SELECT w.word, less.word AS other, less.n AS other_n FROM w JOIN less ON w.word = d
  UNION SELECT less.word, w.word, w.n FROM w JOIN less ON w.word = d
  UNION SELECT a.word, b.word, b.n FROM less AS a JOIN less AS b ON a.d = b.d AND a.i = b.i AND a.word <> b.word),
best AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near FROM found
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, form AS root, 1 AS step FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain AS c JOIN forms AS f ON c.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM forms LEFT JOIN ends USING (word)"""
