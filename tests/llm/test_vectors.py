"""Near-duplicate links and nearest neighbours against brute force."""

import numpy as np
import pytest

from mentionlake.llm import neardup, neighbours
from mentionlake.llm.plans import op7_neardup, op9_neighbours

ODD = [(9001, None), (9002, []), (9003, [0.0] * 8), (9004, [1.0, None] + [0.0] * 6), (9005, [float("nan")] + [1.0] * 7),
       (9006, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (9007, [1.0, 2.0])]


def clusters(n=60, copies=6, d=8, noise=0.04, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n, d))
    x = np.repeat(centres, copies, axis=0) * rng.uniform(0.5, 2, (n * copies, 1))
    x[::2] += noise * rng.normal(size=x[::2].shape)
    return np.r_[x, np.repeat(x[:1], 700, axis=0)]  # one very common vector


def brute_links(x, threshold):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (u @ u.T >= threshold) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    while True:
        lower = np.minimum(label, np.where(linked, label[None], len(x)).min(axis=1))
        if (lower == label).all():
            return linked.sum(axis=1), label
        label = lower


def test_links(frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    x = clusters()
    rows = [(i, v.tolist(), 0, i) for i, v in enumerate(x)] + [(i, v, 1, 0) for i, v in ODD] + [(3, x[3].tolist(), 0, 0)]
    df = frame(rows, "vec_id long, embedding array<double>, label int, links int")
    out = {r["vec_id"]: r for r in neardup.link(df).collect()}
    assert len(out) == len(x) + len(ODD)
    links, component = brute_links(x, 0.95)
    got = np.array([[out[i]["n_links"], out[i]["component_id"]] for i in range(len(x))])
    assert (got[:, 0] <= links).all() and got[:, 0].sum() >= 0.98 * links.sum()
    assert (got[:, 1] == component).mean() > 0.97
    for i, _ in ODD:
        assert out[i]["n_links"] == 0 and out[i]["component_id"] == i
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values() if r["vec_id"] is not None)
    assert neardup.link(df.where("false")).count() == 0


def exact(x, ids, k):
    out = {}
    for i in [i for i in ids if i % 20 == 0]:
        score = (x * x[ids.index(i)]).sum(axis=1)
        ranked = sorted((-s, j) for s, j in zip(score.tolist(), ids) if j != i)[:k]
        out[i] = [j for _, j in ranked]
    return out


@pytest.mark.parametrize("slab,block", [(neighbours.SLAB, neighbours.ROWS), (100, 7)])
def test_neighbours(frame, monkeypatch, slab, block):
    monkeypatch.setattr(neighbours, "SLAB", slab)
    monkeypatch.setattr(neighbours, "ROWS", block)
    x = clusters()
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)] + [(i, v, 0) for i, v in ODD] + [(3, x[3].tolist(), 0)]
    df = frame(rows, "vec_id long, embedding array<double>, score int")
    want = exact(x, list(range(len(x))), 20)
    got = {}
    from pyspark.sql import functions as F

    for r in neighbours.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(want)
    assert np.mean([len(set(got[i]) & set(want[i])) / 20 for i in want]) > 0.9
    assert neighbours.nearest(df.where("false"), F.col("id") % 20 == 0).count() == 0


def test_queries_reach_the_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), [r["vec_id"] for r in rows]
    want = exact(x, ids, 20)
    got = {}
    for r in op9_neighbours(spark, folder).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        assert abs(r["score"] - x[ids.index(r["query_id"])] @ x[ids.index(r["vec_id"])]) < 1e-12
    assert all(len(v) == 20 for v in got.values())
    recall = np.mean([len({j for _, j in got[i]} & set(want[i])) / 20 for i in want])
    print("recall", recall)
    assert recall >= 0.9
    links, component = brute_links(x, 0.95)
    out = {r["vec_id"]: r["n_links"] for r in op7_neardup(spark, folder).collect()}
    assert [out[i] for i in ids] == links.tolist()


@pytest.mark.parametrize("d", [16, 64])
def test_planted_pairs_are_found(frame, d):
    """Pairs at cosines from 0.95 to 0.99 among unrelated vectors, in the dimensions of real tables."""
    rng = np.random.default_rng(d)
    a = rng.normal(size=(400, d))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    cosine = np.tile([0.9501, 0.96, 0.97, 0.99], 100)[:, None]
    x = np.r_[a, cosine * a + np.sqrt(1 - cosine**2) * b, rng.normal(size=(1200, d))]
    links, component = brute_links(x, 0.95)
    out = {r["vec_id"]: r for r in neardup.link(frame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    got = np.array([[out[i]["n_links"], out[i]["component_id"]] for i in range(len(x))])
    assert links.sum() >= 800 and (got[:, 0] <= links).all()
    assert got[:, 0].sum() >= 0.97 * links.sum() and (got[:, 1] == component)[links > 0].mean() >= 0.97


def test_plan_keeps_strangers_and_misses_bounded():
    for n in (10, 1000, 10**6, 10**9):
        count, tables = neardup.plan(n, 0.95)
        assert (1 - neardup.same_cell(0.95) ** count) ** tables <= neardup.MISSED
        assert n * tables * neardup.same_cell(0.0) ** count <= 1.2 * neardup.STRANGERS or n == 10


@pytest.mark.parametrize("n", [1, 2, 15, 30])
def test_short_tables_give_all_candidates(frame, n):
    x = np.random.default_rng(n).normal(size=(n, 64))
    df = frame([(20 * i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, neighbours.F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    if n > 1:
        assert set(got) == {20 * i for i in range(n)}
    assert all([r for r, _ in v] == list(range(1, min(20, n - 1) + 1)) for v in got.values())
    if n == 15:
        assert {i: [j for _, j in v] for i, v in got.items()} == exact(x, [20 * i for i in range(n)], 20)


@pytest.mark.parametrize("d", [64, 256])
@pytest.mark.parametrize("lengths", ["unit", "uneven", "outlier"])
def test_recall_whatever_the_norms(frame, d, lengths):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(2500, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if lengths == "uneven":
        x *= rng.lognormal(0, 0.7, (len(x), 1))
    elif lengths == "outlier":
        x[7] *= 100
    want = exact(x, list(range(len(x))), 20)
    got = {i: set() for i in want}
    for r in neighbours.nearest(frame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), neighbours.F.col("id") % 20 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    recall = np.mean([len(got[i] & set(want[i])) / 20 for i in want])
    print("recall", d, lengths, recall)
    assert recall >= 0.9
