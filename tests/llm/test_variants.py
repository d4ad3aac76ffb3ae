"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from mentionlake.llm import variants


def brute_words(rows):
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += len(run) >= 5
    return {w: n for w, n in seen.items() if n >= 3}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(known):
    forms = {}
    for w, n in known.items():
        near = [(-m, v) for v, m in known.items() if one_edit(w, v)]
        best = min(near, default=(0, None))
        forms[w] = (n, len(near), *((best[1], -best[0]) if near and -best[0] >= 2 * n else (None, None)))
    out = []
    for w in known:
        root = w
        while forms[root][2] is not None:
            root = forms[root][2]
        out.append((w, *forms[w], root))
    return sorted(out)


def vocabulary(n, seed):
    rng = random.Random(seed)
    out = {}
    for _ in range(n):
        w = "".join(rng.choice(["an", "na", "te", "et", "ro", "zé", "ÿ", "xx"]) for _ in range(rng.randint(2, 5)))[: rng.randint(5, 9)]
        if len(w) >= 5:
            out[w] = out.get(w, 2) + rng.choice([1, 1, 3, 20, 200])
    out |= {"n" * 60: 3, "n" * 61: 9, "n" * 59 + "m": 100, "qqqqq": 4, "q" * 300: 5}
    return out


@pytest.mark.parametrize("depth,slab,pairs", [(1, 100_000, 1 << 16), (3, 100_000, 50), (4, 5, 1 << 16), (variants.LEVELS, 3, 7)])
def test_near_words(spark, monkeypatch, depth, slab, pairs):
    monkeypatch.setattr(variants, "SLAB", slab)
    monkeypatch.setattr(variants, "PAIRS", pairs)
    monkeypatch.setattr(variants, "VISITORS", 100)
    known = vocabulary(1000, depth)
    df = spark.createDataFrame(list(known.items()), "word string, n long")
    got = {r["word"]: (r["near"], r["form"], -r["less"]) for r in variants.near_words(df, depth).collect()}
    want = {}
    for w in known:
        near = [(-known[v], v) for v in known if one_edit(w, v)]
        if near:
            want[w] = (len(near), min(near)[1], -min(near)[0])
    assert got == want and len(want) > 100


def test_whole(frame):
    rng = random.Random(3)
    vocab = ["thonre", "thonret", "thonte", "éoire", "Éoire", "çréoi", "ouréaux", "ouréeaux", "letter", "lettre", "letters"]
    rows = [(i if i % 7 else None, " ".join(rng.choice(vocab) for _ in range(60)) + " 12ThonRE-éoire_x", 1) for i in range(200)]
    rows += [(1, None, 1), (2, "", 1), (3, "abc " * 50_000 + "longword " * 30_000, 1), (3, "z" * 100_000, 1)] * 3
    got = sorted(tuple(r) for r in variants.group(variants.words(frame(rows, "doc_id long, text string, n long"))).collect())
    assert [r[:3] + r[3:] for r in got] == brute(brute_words([r[:2] for r in rows]))
    assert any(r[3] for r in got)


def test_chain_of_forms(frame):
    known = [(f"{'a' * i}{'b' * (40 - i)}", 3 * 2**i) for i in range(30)]
    got = {r["word"]: r["root"] for r in variants.group(frame(known, "word string, n long")).collect()}
    assert set(got.values()) == {known[-1][0]}


def test_empty(frame):
    assert variants.group(variants.words(frame([], "doc_id long, text string"))).count() == 0
