"""Targets against an iterative share-out, fixed sizes, unequal inclusion, edges."""

import pytest
from pyspark.sql import functions as F

from mentionlake.llm import mixing


def share_out(sizes, weights, percent, most):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_sources = sum(sizes.values()) * percent / 100, {}, set(names)
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if weight[s] * unit >= most * sizes[s]}
        if not over:
            return target | {s: weight[s] * unit for s in open_sources}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_sources -= over
    return target


@pytest.fixture
def docs(frame):
    rows = [(i, "w " * (i * 7 % 23 + 1), ["a", "b", "c", None, "d"][min(4, i % 9)], 1, 2) for i in range(700)]
    rows += [(701, None, "a", 0, 0), (702, "", "e", 0, 0), (None, "no key", "a", 0, 0), (5, rows[5][1], rows[5][2], 1, 2)]
    return frame(rows, "doc_id long, text string, source string, target int, ratio int")


def test_targets_and_sizes(docs):
    out = mixing.mix(docs).collect()
    assert len(out) == 704
    sizes, taken, target = {}, {}, {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = share_out(sizes, (3, 1, 2), 150, 2)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 0.5
        assert all(r["source_size"] == sizes[s] for r in out if r["source"] == s)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_preferred_documents_are_taken_more_often(docs):
    liked = F.when(F.col("doc_id") % 2 == 0, 5).otherwise(1)
    out = mixing.mix(docs.where("source = 'd'"), weights=(1,), percent=50, prefer=liked).collect()
    rate = [sum(r["taken"] > 0 for r in out if r["doc_id"] % 2 == k) / sum(r["doc_id"] % 2 == k for r in out) for k in (0, 1)]
    assert rate[0] > rate[1] + 0.2
    assert sum(r["taken"] for r in out) == round(out[0]["target"])


def test_whole_rows(docs):
    want = sorted(str(r["doc_id"]) for r in mixing.mix(docs).collect() for _ in range(-(-r["taken"] // max(1, r["size"]))))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == want
    assert out.where("text is null or text = ''").count() == 0


def test_empty(docs):
    assert mixing.mix(docs.where("false")).count() == 0
    assert mixing.mix(docs.where("doc_id in (701, 702)")).where("taken = 0 and target = 0").count() == 2


def test_columns_may_be_called_anything(docs):
    names = ["ratio", "slot", "goal", "edge", "extra", "row", "key", "size", "wanted", "__s", "__copies", "source_size"]
    odd = docs.drop("ratio").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in mixing.mixed(docs).collect())
    assert all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in rows for n in names)
    assert sorted(r["taken"] for r in mixing.mix(odd).collect()) == sorted(r["taken"] for r in mixing.mix(docs).collect())
