"""Links and components against brute force; bounds of trees never lose a pair."""

import random
import re

import numpy as np
import pytest

from mentionlake.llm import jaccard
from mentionlake.llm.plans import op5_jaccard


def shingles(text, width=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width=4, percent=85):
    """{key: (size, smallest key reachable)}; sharing a shingle is needed for a link."""
    sets = {}
    for i, (key, text) in enumerate(rows):
        sets[i] = shingles(text, width)
    label = {i: rows[i][0] for i in sets}
    holders = {}
    for i, s in sets.items():
        if rows[i][0] is not None:
            for t in s:
                holders.setdefault(t, []).append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        if rows[i][0] is None:
            continue
        for j in {j for t in s for j in holders[t] if j < i}:
            if find(i) != find(j) and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                parent[find(i)] = find(j)
    lowest = {}
    for i in sets:
        if label[i] is not None:
            lowest[find(i)] = min(lowest.get(find(i), label[i]), label[i])
    return sorted((str(rows[i][0]), len(sets[i]), str(None if rows[i][0] is None else lowest[find(i)])) for i in sets)


def corpus(seed):
    """Random texts, chains of edits, a large group of near copies, and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(60)]
    rows += [" ".join([*(word() for _ in range(rng.randint(20, 200))), *passage, *(word() for _ in range(30))]) for _ in range(60)]
    for start in range(4):
        text = [word() for _ in range(rng.choice([8, 40, 150]))]
        for _ in range(40):  # each differs a little from the one before
            text = list(text)
            text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
            rows.append(" ".join(text).upper() if rng.random() < 0.2 else " ".join(text) + "\n")
    near = [word() for _ in range(130)]
    for _ in range(120):
        text = list(near)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            text[rng.randrange(len(text))] = word()
        rows.append(" ".join(text))
    rows += ["", "  ", None, "one", "One", "one two", "one two three", "one two three four"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 8)])
def test_components_equal_brute_force(frame, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(seed) + [(5, "a b c d e f g"), (5, "other words than before are here"), (None, "a b c d e f g"), (900, "x " * 30_000)]
    docs = frame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, n int, class int")
    out = jaccard.join(docs).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out) == components_by_key(rows)


def components_by_key(rows):
    """Brute force, where rows of one key are told apart."""
    return brute(rows)


def test_empty(frame):
    docs = frame([], "doc_id long, text string")
    assert jaccard.join(docs).count() == 0
    assert [tuple(r) for r in jaccard.join(frame([(1, None), (2, "")], "doc_id long, text string")).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_traversal_loses_no_pair():
    rng = np.random.default_rng(3)
    for _ in range(20):
        base = rng.integers(0, 2**63, 400).astype(np.uint64)
        sets = [np.unique(np.r_[rng.choice(base, rng.integers(5, 380), replace=False)]) for _ in range(10)]
        for s in list(sets):
            for _ in range(6):
                keep = rng.random(len(s)) > 0.05
                sets.append(np.unique(np.r_[s[keep], rng.integers(0, 2**63, rng.integers(0, 9)).astype(np.uint64)]))
        n = np.array([len(s) for s in sets])
        groups = rng.integers(0, 12, len(sets))
        tree = jaccard.Tree(np.arange(len(sets)), n, groups, [jaccard.bitmap(s) for s in sets])
        found = jaccard.traverse(tree, tree, 85)
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if groups[i] != groups[j] and 100 * both >= 85 * (n[i] + n[j] - both):
                    assert (j, i) in found


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = op5_jaccard(spark, folder).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute(rows)


def test_one_of_each_when_keys_repeat_with_other_texts(frame):
    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    one, two, three, clean = text("a"), text("b"), text("c"), text("d")
    rows = [
        (1, one), (5, one + " added"), (5, clean),  # a near copy and a clean text of one key
        (2, two), (2, two + " added"), (8, two + " more"),  # near copies that share the smallest key
        (3, three), (3, three), (4, None), (4, None), (4, ""), (None, one), (6, text("e")), (9, clean + " more"),
    ]
    out = jaccard.one_of_each(frame([(*r, 1) for r in rows], "doc_id long, text string, class int")).collect()
    assert all(r["class"] == 1 for r in out)
    got = [(r["doc_id"], r["text"]) for r in out]
    assert len(got) == len(set(got))
    assert set(got) == {(1, one), (5, clean), (2, two), (3, three), (4, None), (4, ""), (None, one), (6, text("e"))}


def test_one_of_each_with_columns_of_any_name(frame):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, text + " more"), (3, "something else that is quite different from it"), (1, "a third text of a repeated key altogether")]
    names = ["__gone", "__twice", "_____gone", "class", "component_id", "__key", "__text"]
    df = frame([(*r, *names) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"], r["__gone"]) for r in out.collect()) == sorted((i, t, "__gone") for i, t in (rows[0], *rows[2:]))


def test_a_group_of_near_copies_is_tried_against_few_classes(frame, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        at = rng.randrange(len(base))
        rows.append((i, " ".join([*base[:at], rng.choice("abc"), *base[at + 1 :]])))
    tried = []
    decide = jaccard.Join.links
    monkeypatch.setattr(jaccard.Join, "links", lambda self, pairs: tried.append(pairs.count()) or decide(self, pairs))
    out = jaccard.join(frame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out) == brute(rows)
    assert sum(tried) <= jaccard.TRIED * len(rows)


def test_near_copies_too_far_apart_are_seldom_taken_for_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    sets = [np.unique(np.r_[base[rng.random(40) > 0.12], rng.integers(0, 2**63, 5).astype(np.uint64)]) for _ in range(150)]
    n = np.array([len(s) for s in sets])
    tree = jaccard.Tree(np.arange(150), n, np.arange(150), [jaccard.bitmap(s, jaccard.WIDE) for s in sets])
    links = set()
    for i in range(150):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 70 * (n[i] + n[j] - both):
                links.add((j, i))
    found = jaccard.traverse(tree, tree, 70)
    assert links <= found and len(found) <= 3 * len(links)


def test_tokens_of_many_texts_come_last(spark, frame):
    rng = random.Random(6)
    fresh = lambda n: [f"x{rng.getrandbits(60)}" for _ in range(n)]
    passages = [fresh(12) for _ in range(4)]
    rows = [(i, " ".join([*fresh(60), *passages[i % 4], *fresh(60)])) for i in range(160)]
    work = jaccard.Join(frame(rows, "doc_id long, text string"), "doc_id", "text", 4, 85)
    assert work.entries.count() == 0 and work.bitmaps.count() == 0


def test_first_tokens_and_bitmaps_are_not_grouped(frame):
    text = lambda name: " ".join(f"{name}{i}" for i in range(30))
    rows = [(3, text("a")), (1, text("a")), (1, text("a")), (2, text("a") + " more"), (None, text("b")), (7, text("b")), (8, None)]
    work = jaccard.Join(frame(rows, "doc_id long, text string"), "doc_id", "text", 4, 85)
    assert {r["holder"] for r in work.classes.collect()} == {1, 2, 7}
    assert "first" not in work.classes.columns and work.bitmaps.count() == 2
    assert all(r["size"] == 2 for r in work.entries.collect())
