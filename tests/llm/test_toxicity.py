"""Output against a plain convolution, gradients against differences of the loss, word hashes, edges, and
held-out accuracy."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from mentionlake.llm import toxicity, words
from mentionlake.llm.plans import op6_toxicity


def test_hashes_tell_words_apart(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 64)
    rows = ["The the THE \x0b cat", "", "  ", "é É ab\tba", "x" * 500 + " y", "the"] * 3
    hashes, counts = words.hash_words(rows, words.SPACES)
    want = [re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in rows]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def sample(n, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        text = [f"w{rng.integers(400)}" for _ in range(rng.integers(3, 60))]
        if toxic:
            text.insert(int(rng.integers(len(text))), "idiot")
        rows.append((" ".join(text), toxic, "en" if i % 2 else None))
    return rows


def test_stretches_do_not_change_scores(monkeypatch):
    model = toxicity.Classifier(sample(300))
    rows = [t for t, _, _ in sample(40, 8)] + ["", "one", "w1 " * 500 + "idiot"]
    whole = model.score(rows)
    monkeypatch.setattr(toxicity, "PART_WORDS", 7)
    assert np.allclose(model.score(rows), whole, atol=1e-5)
    assert (model.score(["w1 " * 300 + "idiot", "w1 " * 300]) >= toxicity.DECIDED).tolist() == [True, False]


def plain_forward(network, words):
    """Log odds of one text, given as buckets, window by window."""
    hidden = []
    for k, w in enumerate(toxicity.WIDTHS):
        for j in range(toxicity.FILTERS):
            sums = [
                network.bias[k][j] + sum(
                    float(np.dot(network.embedding[words[i + o]].astype(float), network.filters[k][o][:, j]))
                    for o in range(w) if i + o < len(words))
                for i in range(len(words))
            ]
            hidden.append(max([0.0, *sums]))
    return float(np.dot(hidden, network.out)) + float(network.shift[0])


def buckets_of(text):
    found, starts, ends = toxicity.padded([text])
    return found[starts[0] : ends[0]].tolist()


def test_output_equals_a_plain_convolution():
    network = toxicity.Network(5)
    model = object.__new__(toxicity.Classifier)
    model.languages = ["any"]
    model.rows = np.concatenate([network.table(), np.zeros((toxicity.BUCKETS + 1, 1))], axis=1).astype(np.float32)
    model.bias, model.out, model.shift = network.bias, network.out, network.shift
    rows = [t for t, _, _ in sample(25, 4)] + ["", "one", "one two"]
    got, _ = model.raw(rows)
    odds = np.array([plain_forward(network, buckets_of(t)) for t in rows])
    assert np.allclose(got, 1 / (1 + np.exp(-odds)), atol=1e-5) and np.ptp(odds) > 0.1


def test_gradients_equal_differences_of_the_loss():
    """The step of a parameter tells the sign of its gradient, what it adds to the sums the square."""
    network = toxicity.Network(2)
    rows, labels = ["a b c d", "c a", "", "e e b"], np.array([1, 0, 1, 0], np.float32)
    words = [buckets_of(t) for t in rows]

    def loss():
        odds = np.array([plain_forward(network, w) for w in words])
        return float(np.mean(np.log1p(np.exp(odds)) - labels * odds))

    def values():
        return [network.out, network.shift, network.bias, *network.filters, network.embedding]

    used = sorted({b for w in words for b in w})
    want = []
    for value in values():
        places = [(b, d) for b in used for d in range(3)] if value is network.embedding else list(np.ndindex(value.shape))[::7]
        for at in places:
            before = value[at]
            value[at] = before + 1e-3
            up, high = loss(), float(value[at])
            value[at] = before - 1e-3
            down, low = loss(), float(value[at])
            value[at] = before
            want.append((up - down) / (high - low))
    old, sums = [v.copy() for v in values()], [np.zeros(v.shape) for v in values()]
    network.step(*toxicity.padded(rows), labels, sums)
    got = []
    for new, was, square in zip(values(), old, sums):
        places = [(b, d) for b in used for d in range(3)] if new is network.embedding else list(np.ndindex(new.shape))[::7]
        got += [float(np.sign(was[at] - new[at]) * np.sqrt(square[at])) for at in places]
    assert np.allclose(got, want, atol=2e-4) and np.abs(want).max() > 0.01
    assert not network.embedding[toxicity.BUCKETS].any()


def test_edges(frame):
    docs = frame([(i, t, l, 1.0) for i, (t, _, l) in enumerate(sample(200))] + [(900, None, None, 0.0), (None, "", None, 0.0), (3, "idiot", None, 0.0)],
                 "doc_id long, text string, lang string, score double")
    labels = frame([(i, y, 1) for i, (_, y, _) in enumerate(sample(200))] + [(1, None, 1), (2, 5, 1), (None, 1, 1)],
                   "doc_id long, toxic int, quality int")
    out = toxicity.score(docs, labels).collect()
    assert len(out) == 203 and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in toxicity.score(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), labels).count() == 0


def test_words_and_thresholds_come_from_all_rows(frame, monkeypatch):
    """Beyond the few rows that are sampled, every row counts."""
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 20)
    rows = sample(600)
    docs = frame([(i, t, lang) for i, (t, _, lang) in enumerate(rows)], "key long, text string, lang string")
    labels = frame([(i, y) for i, (_, y, _) in enumerate(rows)], "key long, toxic int")
    known = toxicity.labelled(labels, F.lit(True), "key", "toxic")
    held = {r["key"] for r in known.where("held").collect()}
    counts = toxicity.count_words(docs, known)
    assert counts.rows == 600 - len(held) and 0 < len(held) < 300
    clean = known.withColumn("label", F.lit(0))
    assert toxicity.count_words(docs, clean).positives == 0  # no row of some kinds
    bucket = buckets_of("idiot")[0]
    assert counts.hits[bucket] == sum(y for i, (_, y, _) in enumerate(rows) if i not in held)
    seen, decide = [], toxicity.Classifier.decide
    monkeypatch.setattr(toxicity.Classifier, "decide", lambda self, *a: (seen.append((a[3].sum(), a[4].sum())), decide(self, *a)))
    out = toxicity.score(docs, labels, key="key").collect()
    assert len(out) == 600 and seen == [(len(held), sum(rows[i][1] for i in held))]


def test_bags():
    rows = ["b a B", "", "x " * 300 + "y", *(t for t, _, _ in sample(20))]
    for text, bag in zip(rows, toxicity.bags(rows)):
        buckets, n = toxicity.unpacked(toxicity.packed(*bag))
        assert dict(zip(buckets.tolist(), n.tolist())) == Counter(buckets_of(text))
        assert sorted(buckets.tolist()) == buckets.tolist()


def test_texts_outside_the_sample_do_not_move(frame, monkeypatch):
    """Bags and scores meet the labels, of a repeated key those of its least text; no other join has texts."""
    rows = [(f"filler{i} " + t, y, lang) for i, (t, y, lang) in enumerate(sample(300))]
    docs = frame([(i, t, lang) for i, (t, _, lang) in enumerate(rows)], "key long, text string, lang string")
    more = [(i, text, "zz") for i in range(60) for text in (None, "zebra")]
    labels = frame([(i, y) for i, (_, y, _) in enumerate(rows)], "key long, toxic int")
    known = toxicity.labelled(labels, F.lit(True), "key", "toxic")
    repeated = docs.unionByName(frame(more, "key long, text string, lang string"))
    once, twice = toxicity.count_words(docs, known), toxicity.count_words(repeated, known)
    assert once.rows == twice.rows and (once.texts == twice.texts).all() and (once.hits == twice.hits).all()
    joined, join = [], toxicity.one_of_a_key
    monkeypatch.setattr(toxicity, "one_of_a_key", lambda *a: joined.append(a) or join(*a))
    assert toxicity.score(docs, labels, key="key").count() == 300
    assert len(joined) == 1  # the sample


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = op6_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r["toxic"] for r in rows]), np.array([r["predicted"] for r in rows])
    tp = (y * p).sum()
    print("precision", tp / max(1, p.sum()), "recall", tp / y.sum(), "rate", y.mean())
    assert tp / p.sum() > 0.8 and tp / y.sum() > 0.6
