"""Hard negatives against brute force."""

import math

import numpy as np
import pytest

from mentionlake.llm import negatives

ODD = [(9001, None, 1), (9002, [1.0] * 8, None), (9003, [1.0, None] + [0.0] * 6, 1), (9004, [float("nan")] * 8, 1),
       (9100, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (9200, [1.0, 2.0], 1), (9300, [], 1), (9301, [], 1), (9302, [], 2),
       (9400, [0.0] * 8, 1), (9500, [1e300] * 8, 1)]


def brute(rows, every, k=5):
    good = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) and abs(x) < 1e200 for x in v):
            good.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in good.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, l == label) for i, (l, w) in good.items() if i != a and len(w) == len(v))
        for p, pid, _ in [s for s in scored if s[2]][:k]:
            fit = [(s, i) for s, i, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p][:k]
            out += [(a, pid, n + 1, i, -p, -s) for n, (s, i) in enumerate(fit)]
    return sorted(out)


def vectors(n, d, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, d))
    x *= rng.lognormal(0, 0.5, (n, 1))
    x[: n // 4] = x[n // 4]  # a hot vector: ties
    labels = np.where(rng.random(n) < 0.6, 0, rng.integers(0, 5, n))
    return [(int(i), v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels))]


@pytest.mark.parametrize("slab,block,n,d,spread", [(4096, 64, 500, 8, 0.5), (60, 3, 500, 8, 0.1), (40, 64, 400, 13, 1.0)])
def test_mining(frame, monkeypatch, slab, block, n, d, spread):
    monkeypatch.setattr(negatives, "SLAB", slab)
    monkeypatch.setattr(negatives, "BLOCK", block)
    rows = vectors(n, d, slab, spread) + ODD
    rows += rows[3:5]  # repeated rows
    df = frame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<double>, label int, home int, win int")
    got = sorted(tuple(r) for r in negatives.mine(df, negatives.F.col("id") % 20 == 0).collect())
    assert got == brute(rows, 20) and len(got) > 50


def test_bounds_lose_nothing():
    rng = np.random.default_rng(5)
    import pyarrow as pa

    x = (rng.normal(size=(300, 16)) * rng.exponential(1, 16) * 100).astype(np.int64)
    rows = pa.table({"dim": [16] * 300, "id": range(300), "label": [0] * 300, "vec": x.tolist()})
    index = negatives.Index(rows)
    asks = (rng.normal(size=(20, 16)) * 100).astype(np.int64)
    scores = asks @ x.T
    for q in (0, 50, 90, 99, 99.9):
        least = np.percentile(scores, q, axis=1).astype(np.int64)
        i, j, s = index.above(asks, least)
        assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(scores >= least[:, None]))) and (s == scores[i, j]).all()


def test_empty(frame):
    df = frame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(df, negatives.F.col("id") % 2 == 0).count() == 0
    one = frame([(1, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(one, negatives.F.col("id") % 2 == 0).count() == 0
