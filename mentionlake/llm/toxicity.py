"""Toxicity: a convolutional text classifier over hashed words.

Words (lower-cased runs of letters and digits) are hashed to embeddings; filters of several widths run
over them, each is rectified and pooled by its maximum over the text, and a logistic layer gives the
score. A quarter of all labelled rows, by a hash of the key, is held back. Of the others, every row counts for the odds
of words, the rare words and the words of a language; the filters are trained in numpy on whole texts of a bounded
sample of them. Every text is scored once, where it lies; held-back rows set a threshold for each language, and scores
are stretched so that every threshold lies at ``DECIDED``; the language is told from the words of the text, never from a
column. Texts outside the sample do not move: only their counts of words meet the labels, and their scores.

Null and empty texts get the score of a text without words; repeated rows stay repeated; labels that are
null or neither 0 nor 1 are not learned from, of several labels of one key the largest counts; without
labels of both sorts every score is 0. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.llm.common import ready, share, texts, tidy
from mentionlake.llm.words import MARKS, hash_words
from mentionlake.session import materialize

SAMPLE_ROWS = 4_000  # labelled rows of each label that may be learned from; their texts are taken whole
BUCKETS = 1 << 17
DIMENSIONS = 16
FILTERS = 12
WIDTHS = (1, 2, 3)
EPOCHS = 4
BATCH = 64
RATE = 0.06
DECIDED = 0.7
LEAST_TEXTS = 4  # texts of the sample that a word must occur in to count
LEAST_POSITIVES = 25  # held-back toxic rows that a language needs for a threshold of its own
PART_WORDS = 60_000
PAD = max(WIDTHS) - 1
HOLD = 4  # one in so many labelled rows is held back for the thresholds
STEPS = 1 << 16  # ranges of scores between which a threshold may lie
HEAD = 24  # first characters of a text by which, and then by its hash, the least text of a key is told
HALF = 1 << 16  # buckets below it and the others are told apart by their number, so each takes two bytes


def padded(rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets with padding after each text, first and last word place of each text)."""
    hashes, counts = hash_words(rows, MARKS)
    ends = np.cumsum(counts)
    starts = ends - counts
    shift = PAD * np.arange(len(rows))
    out = np.full(int(counts.sum()) + PAD * len(rows), BUCKETS, np.int64)
    out[np.arange(len(hashes)) + np.repeat(shift, counts)] = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    return out, starts + shift, ends + shift


def bags(rows: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets in order, how often each occurs) of each text."""
    hashes, counts = hash_words(rows, MARKS)
    own = np.repeat(np.arange(len(rows)), counts)
    cells, n = np.unique(own * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    bounds = np.searchsorted(cells, np.arange(len(rows) + 1) * BUCKETS).tolist()
    return [(cells[a:b] % BUCKETS, n[a:b]) for a, b in zip(bounds, bounds[1:])]


def packed(buckets: np.ndarray, n: np.ndarray) -> bytes:
    """A bag in three bytes a bucket, or six if a word occurs more than 255 times."""
    sizes = np.array([np.searchsorted(buckets, HALF), len(buckets)], np.int32)
    kind = np.uint8 if n.max(initial=0) < 256 else np.uint32
    return sizes.tobytes() + (buckets % HALF).astype(np.uint16).tobytes() + n.astype(kind).tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, size = np.frombuffer(data, np.int32, 2).tolist()
    buckets = np.frombuffer(data, np.uint16, size, 8).astype(np.int64)
    buckets[low:] += HALF
    kind = np.uint8 if len(data) == 8 + 3 * size else np.uint32
    return buckets, np.frombuffer(data, kind, size, 8 + 2 * size)


class Network:
    """Embeddings, filters and the logistic layer."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
        self.embedding[BUCKETS] = 0
        self.filters = [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[0, 0, : FILTERS // 2] = 1  # half of the filters start from the words' own odds
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def step(self, buckets, starts, ends, labels, sums) -> None:
        """One step of adaptive gradient descent on a batch of texts."""
        x = self.embedding[buckets]
        n = len(starts)
        pooled = np.zeros((n, len(WIDTHS), FILTERS), np.float32)
        places = np.zeros((n, len(WIDTHS), FILTERS), np.int64)
        for k, w in enumerate(WIDTHS):
            last = len(x) - PAD
            y = sum(x[o : last + o] @ self.filters[k][o] for o in range(w)) + self.bias[k]
            for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
                if b > a:
                    at = y[a:b].argmax(axis=0)
                    places[i, k] = a + at
                    pooled[i, k] = y[a + at, np.arange(FILTERS)]
        alive = pooled > 0
        hidden = (pooled * alive).reshape(n, -1)
        p = 1 / (1 + np.exp(-(hidden @ self.out + self.shift)))
        slope = ((p - labels) / n).astype(np.float32)
        inner = (slope[:, None] * self.out).reshape(pooled.shape) * alive
        grads = [(self.out, hidden.T @ slope), (self.shift, slope.sum(keepdims=True)), (self.bias, inner.sum(0))]
        touched, flows = [], []
        for k, w in enumerate(WIDTHS):
            g = np.zeros_like(self.filters[k])
            for o in range(w):
                word = buckets[places[:, k] + o]
                g[o] = np.einsum("nfd,nf->df", self.embedding[word], inner[:, k])
                touched.append(word.ravel())
                flows.append((inner[:, k, :, None] * self.filters[k][o].T[None]).reshape(-1, DIMENSIONS))
            grads.append((self.filters[k], g))
        word, back = np.unique(np.concatenate(touched), return_inverse=True)
        flow = np.zeros((len(word), DIMENSIONS), np.float32)
        np.add.at(flow, back, np.concatenate(flows))
        for i, (value, g) in enumerate(grads):
            sums[i] += g * g
            value -= RATE * g / (np.sqrt(sums[i]) + 1e-6)
        own = word < BUCKETS
        sums[-1][word[own]] += flow[own] ** 2
        self.embedding[word[own]] -= RATE * flow[own] / (np.sqrt(sums[-1][word[own]]) + 1e-6)

    @staticmethod
    def _odds(counts: "WordCounts") -> np.ndarray:
        """Smoothed log odds of the label given a word: where the first dimension starts."""
        share, hits, all_texts = counts.share, counts.hits, counts.texts
        p = np.clip((hits + 4 * share) / (all_texts + 4), 1e-3, 1 - 1e-3)
        return np.clip(np.log(p / (1 - p)) - np.log(share / (1 - share)), -1, 4) / 2

    def train(self, rows: list[str], labels: np.ndarray, counts: "WordCounts", seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        sums = [np.full_like(v, 1e-4) for v in (self.out, self.shift, self.bias, *self.filters, self.embedding)]
        parts = [padded([t]) for t in rows]
        rare = counts.texts < LEAST_TEXTS
        self.embedding[:, 0] = self._odds(counts)
        self.embedding[rare] = 0
        for buckets, _, _ in parts:
            buckets[rare[buckets]] = BUCKETS
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                sizes = np.cumsum([0, *(len(parts[i][0]) for i in batch)])
                starts = sizes[:-1]
                ends = np.array([s + parts[i][2][0] for s, i in zip(starts, batch)])
                self.step(np.concatenate([parts[i][0] for i in batch]), starts, ends, labels[batch], sums)

    def table(self) -> np.ndarray:
        """What each word adds to each filter at each place of its window: one row per bucket."""
        return np.concatenate([self.embedding @ f[o] for f in self.filters for o in range(len(f))], axis=1)


class WordCounts:
    """Of each bucket: texts with it, toxic ones of these, and how often it occurs in each language."""

    def __init__(self):
        self.texts, self.hits = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        self.words: dict[str, np.ndarray] = {}
        self.rows = self.positives = 0.0

    def add(self, bag: tuple[np.ndarray, np.ndarray], label: int, lang: str | None) -> None:
        buckets, n = bag
        self.rows += 1
        self.positives += label
        for own in (buckets, BUCKETS):  # every text has padding
            self.texts[own] += 1
            self.hits[own] += label
        if lang is not None:
            self.words.setdefault(lang, np.zeros(BUCKETS + 1))[buckets] += n

    @property
    def share(self) -> float:
        return self.positives / self.rows

    def cells(self) -> list[tuple[str, str | None, np.ndarray, np.ndarray]]:
        """(kind, language, buckets, counts) of what is not zero; bucket 0 of "rows" and "positives" has a total."""
        found = [("rows", None, np.array([self.rows])), ("positives", None, np.array([self.positives])),
                 ("texts", None, self.texts), ("hits", None, self.hits)]
        found += [("words", lang, words) for lang, words in self.words.items()]
        return [(kind, lang, np.flatnonzero(n), n[np.flatnonzero(n)]) for kind, lang, n in found]

    @classmethod
    def of_cells(cls, cells: pa.Table) -> "WordCounts":
        out = cls()
        for pair in cells.group_by(["kind", "lang"]).aggregate([]).to_pylist():
            kind, lang = pair["kind"], pair["lang"]
            own = pc.field("kind") == kind
            part = cells.filter(own & (pc.field("lang") == lang) if lang is not None else own)
            found = np.zeros(BUCKETS + 1)
            found[part.column("bucket").to_numpy()] = part.column("n").to_numpy()
            if kind == "words":
                out.words[lang] = found
            else:
                setattr(out, kind, found if kind in ("texts", "hits") else found[0])
        return out


def _steps(raw: np.ndarray) -> np.ndarray:
    """Range of each score: even in log odds."""
    odds = np.clip(raw.astype(float), 1e-12, 1 - 1e-9)
    return np.clip((np.log(odds / (1 - odds)) + 28) / 56 * STEPS, 0, STEPS - 1).astype(int)


def _merged(low, high, rows, hits) -> tuple[np.ndarray, ...]:
    """The ranges of all languages together; ranges that overlap become one."""
    order = np.argsort(low, kind="stable")
    low, high, rows, hits = low[order], high[order], rows[order], hits[order]
    first = np.flatnonzero(np.r_[True, low[1:] > np.maximum.accumulate(high)[:-1]])
    return (low[first], np.maximum.reduceat(high, first), np.add.reduceat(rows, first), np.add.reduceat(hits, first))


class Classifier:
    """A trained network with its thresholds by language.

    Without ``counts`` those of the sample's own training rows are taken; thresholds come from its held-back
    rows (one in ``hold``) until ``decide`` sets them from more.
    """

    def __init__(self, sample: list[tuple[str, int, str | None]], hold: int = HOLD, counts: WordCounts | None = None):
        labels = np.array([s[1] for s in sample], np.float32)
        self.usable = len(sample) > 0 and 0 < labels.sum() < len(labels)
        if not self.usable:
            return
        held = np.arange(len(sample)) % hold == 0 if hold else np.zeros(len(sample), bool)
        rows = [s[0] for s in sample]
        if counts is None:
            counts = WordCounts()
            for (text, label, lang), h in zip(sample, held):
                if not h:
                    counts.add(bags([text])[0], label, lang)
        network = Network()
        network.train([r for r, h in zip(rows, held) if not h], labels[~held], counts)
        self.languages = sorted(counts.words) or ["any"]
        self.rows = np.concatenate([network.table(), self._words_by_language(counts)], axis=1).astype(np.float32)
        self.bias, self.out, self.shift = network.bias, network.out, network.shift
        self.thresholds = np.full(len(self.languages), 0.5)
        if hold:
            raw, lang = self.raw([r for r, h in zip(rows, held) if h])
            self.decide(raw, raw, lang, np.ones(len(raw)), labels[held])

    def _words_by_language(self, counts: WordCounts) -> np.ndarray:
        """Log share of each bucket in the words of each language."""
        empty = np.zeros(BUCKETS + 1)
        shares = np.stack([counts.words.get(lang, empty) for lang in self.languages], axis=1) + 0.5
        logs = np.log(shares / shares.sum(axis=0))
        logs -= logs.mean(axis=1, keepdims=True)
        logs[BUCKETS] = 0
        return logs

    @staticmethod
    def _best(low: np.ndarray, high: np.ndarray, rows: np.ndarray, hits: np.ndarray) -> float:
        """Threshold with the best F1, midway between the scores around it, of rows counted by ranges of scores."""
        order = np.argsort(-low, kind="stable")
        f1 = 2 * np.cumsum(hits[order]) / (np.cumsum(rows[order]) + hits.sum())
        k = int(np.argmax(f1))
        below = high[order[k + 1]] if k + 1 < len(low) else 0.0
        return float(np.clip((low[order[k]] + below) / 2, 1e-6, 1 - 1e-6))

    def decide(self, low, high, lang, rows, hits) -> None:
        """Set the thresholds from ranges of scores: lowest and highest score, language, rows and toxic rows of each."""
        if not len(low):
            return
        self.thresholds = np.full(len(self.languages), self._best(*_merged(low, high, rows, hits)))
        for i in range(len(self.languages)):
            own = lang == i
            if hits[own].sum() >= LEAST_POSITIVES:
                self.thresholds[i] = self._best(low[own], high[own], rows[own], hits[own])

    def raw(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(network output, language number) of each text."""
        scores, langs, part, size = [], [], [], 0
        for i, text in enumerate(rows):
            part.append(text)
            size += len(text) // 5
            if size >= PART_WORDS or i + 1 == len(rows):
                s, g = self._raw(part)
                scores.append(s)
                langs.append(g)
                part, size = [], 0
        return (np.concatenate(scores), np.concatenate(langs)) if scores else (np.empty(0), np.empty(0, int))

    def _raw(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        buckets, starts, ends = padded(rows)
        pooled = np.zeros((len(rows), len(WIDTHS), FILTERS), np.float32)
        votes = np.zeros((len(rows), len(self.languages)))
        # long texts go in stretches of words, each with the words that its last windows need
        firsts = [(i, a) for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist()))
                  for a in range(s, e, PART_WORDS)]
        group: list[tuple[int, int, int]] = []
        for n, (i, a) in enumerate(firsts):
            group.append((i, a, min(a + PART_WORDS, int(ends[i]))))
            if n + 1 == len(firsts) or firsts[n + 1][1] - group[0][1] >= PART_WORDS:
                low, high = group[0][1], group[-1][2]
                self._pool(self.rows[buckets[low : high + PAD]], low, group, pooled, votes)
                group = []
        hidden = np.maximum(pooled, 0).reshape(len(rows), -1)
        return 1 / (1 + np.exp(-(hidden @ self.out + self.shift))), votes.argmax(axis=1)

    def _pool(self, x, low, group, pooled, votes) -> None:
        owner = [g[0] for g in group]
        cuts = np.array([c - low for _, a, b in group for c in (a, b)])
        size = len(x) - PAD
        column = 0
        for k, w in enumerate(WIDTHS):
            y = x[:size, column : column + FILTERS].copy()
            for o in range(1, w):
                y += x[o : size + o, column + o * FILTERS : column + (o + 1) * FILTERS]
            column += w * FILTERS
            top = np.maximum.reduceat(y, cuts[:-1] if cuts[-1] == size else cuts, axis=0)[::2] + self.bias[k]
            np.maximum.at(pooled, (owner, k), top)
        at = cuts[:-1] if cuts[-1] == size else cuts
        np.add.at(votes, owner, np.add.reduceat(x[:size, column:], at, axis=0)[::2])

    def score(self, rows: list[str]) -> np.ndarray:
        """Scores between 0 and 1; ``DECIDED`` is the threshold of every language."""
        if not self.usable:
            return np.zeros(len(rows))
        raw, lang = self.raw(rows)
        return stretched(raw, self.thresholds[lang])


def stretched(raw: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Scores whose thresholds ``t`` lie at ``DECIDED``."""
    return np.where(raw < t, DECIDED * raw / t, DECIDED + (1 - DECIDED) * (raw - t) / (1 - t))


def held_back(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("held"), key), F.lit(HOLD)) == 0


def labelled(labels: DataFrame, learn: Column, key: str, label: str) -> DataFrame:
    """(key, label, held) of each key that may be learned from."""
    known = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    one = known.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    return one.withColumn("held", held_back("key"))


def one_of_a_key(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(key, label, text, lang) of the known keys; a key that is repeated counts once."""
    both = rows.join(known, "key").groupBy("key", "label")
    return both.agg(F.min("text").alias("text"), F.min("lang").alias("lang"))


def sample_rows(rows: DataFrame, known: DataFrame) -> list[tuple[str, int, str | None]]:
    """About ``SAMPLE_ROWS`` rows of each label, picked by a hash of their key where they lie."""
    known = known.where("NOT held")
    counts = dict(known.groupBy("label").count().collect())
    of_label = F.when(F.col("label") == 1, F.lit(counts.get(1, 0))).otherwise(F.lit(counts.get(0, 0)))
    picked = known.where(share("key", of_label, SAMPLE_ROWS))
    found = one_of_a_key(rows, F.broadcast(picked)).orderBy(F.xxhash64("key"), "key").collect()
    return [(r["text"] or "", r["label"], r["lang"]) for r in found]


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with what puts the texts of a key in order, so that they need not be compared themselves."""
    return rows.withColumns({"head": F.substring("text", 1, HEAD), "hash": F.xxhash64("text")})


def least(values: Column) -> Column:
    """The values of the least text of a key; a missing one is the last."""
    return F.min_by(values, F.struct(F.col("head").isNull(), "head", "hash"))


def bagged(rows: DataFrame) -> DataFrame:
    """(key, lang, head, hash, bag) of the rows."""

    def run(batches):
        for batch, part in texts(batches):
            bag = pa.array([packed(*b) for b in bags(part)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], bag], ["key", "lang", "head", "hash", "bag"])

    kind = rows.schema["key"].dataType.simpleString()
    return placed(rows.select("key", "text", "lang")).mapInArrow(
        tidy(run), f"key {kind}, lang string, head string, hash long, bag binary")


def count_words(rows: DataFrame, known: DataFrame) -> WordCounts:
    """Counts over all keys that are not held back. The texts stay where they lie, their bags meet the labels."""

    def counted(batches):
        counts = WordCounts()
        for batch in batches:
            for bag, label, lang in zip(*(batch.column(c).to_pylist() for c in ("bag", "label", "lang"))):
                counts.add(unpacked(bag), label, lang)
        for kind, lang, buckets, n in counts.cells():
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(n), pa.string()), pa.array([lang] * len(n), pa.string()), pa.array(buckets), pa.array(n)],
                ["kind", "lang", "bucket", "n"])

    if rows.schema["key"].dataType == known.schema["key"].dataType:  # else their hashes differ
        rows = rows.where(~held_back("key"))
    own = bagged(rows).join(known.where("NOT held"), "key").groupBy("key", "label")
    own = own.agg(least(F.col("bag")).alias("bag"), F.min("lang").alias("lang")).drop("key")
    cells = own.mapInArrow(tidy(counted), "kind string, lang string, bucket long, n double")
    return WordCounts.of_cells(cells.groupBy("kind", "lang", "bucket").agg(F.sum("n").alias("n")).toArrow())


def raw_scores(model: Classifier, rows: DataFrame) -> DataFrame:
    """(key, head, hash, raw, lang, step) of every row: the network's output, language number and range."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch, part in texts(batches):
            raw, lang = shared.value.raw(part)
            columns = [pa.array(raw.astype(np.float32)), pa.array(lang.astype(np.int32)), pa.array(_steps(raw).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *columns], ["key", "head", "hash", "raw", "lang", "step"])

    kind = rows.schema["key"].dataType.simpleString()
    return placed(rows.select("key", "text")).mapInArrow(
        tidy(scored), f"key {kind}, head string, hash long, raw float, lang int, step int")


def set_thresholds(model: Classifier, scores: DataFrame, known: DataFrame) -> None:
    """Thresholds from all keys held back; a key that is repeated counts once."""
    own = scores.join(known.where("held"), "key").groupBy("key", "label")
    own = own.agg(least(F.struct("raw", "lang", "step")).alias("least")).select("label", "least.*")
    raw = F.col("raw").cast("double")
    ranges = (
        own.groupBy("lang", "step").agg(
            F.min(raw).alias("low"), F.max(raw).alias("high"), F.count("*").alias("rows"), F.sum("label").alias("hits"))
        .toArrow()
    )
    model.decide(*(ranges.column(c).to_numpy() for c in ("low", "high", "lang", "rows", "hits")))


def score(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text",
    label: str = "toxic", lang: str = "lang",
) -> DataFrame:
    """(key, score) of every row of ``docs``; learns from rows of ``labels`` where ``learn`` holds."""
    ready(docs.sparkSession)
    known = labelled(labels, F.lit(True) if learn is None else learn, key, label)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sample = sample_rows(rows, known)
    model = Classifier(sample, hold=0, counts=count_words(rows, known) if sample else None)
    if not model.usable:
        return docs.select(key, F.lit(0.0).alias("score"))
    scores = materialize(raw_scores(model, rows), "raw-scores")
    set_thresholds(model, scores, known)
    thresholds = model.thresholds
    kind = docs.schema[key].dataType.simpleString()

    def final(batches):
        for batch in batches:
            raw, lang = (batch.column(c).to_numpy() for c in ("raw", "lang"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(stretched(raw, thresholds[lang]))], ["key", "score"])

    return scores.select("key", "raw", "lang").mapInArrow(final, f"key {kind}, score double").withColumnRenamed("key", key)
