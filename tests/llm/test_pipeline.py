"""Stages of the pipeline against brute force on a small table with planted cases."""

import hashlib

import pytest

import corpus_pipeline
from mentionlake.llm import pii

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text", "lang", "source", "n_chars").collect()]
    long = max((r[1] for r in rows), key=len)
    rows += [(9001, None, "en", "src0", 0), (9002, "", "en", "src1", 0), (9003, "1234 !!", "en", "src2", 7),
             (9004, long + " added", "en", "src3", 1), (9005, "write to some.one@mail.example.org today please", "en", None, 1)]
    return spark.createDataFrame(rows, COLUMNS)


def test_stages(spark, docs):
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, "").cache()
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        before, after = ([r.asDict() for r in d.collect()] for d in (seen, out))
        ids = {r["doc_id"] for r in after}
        if name == "language":
            want = {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or "")}
            assert ids == want and len(after) == len(want)
        if name == "near_duplicates":
            from test_jaccard import brute

            groups = brute([(r["doc_id"], r["text"]) for r in before], 5, 80)
            assert ids == {int(c) for _, _, c in groups} and len(after) == len(ids) and 9004 not in ids
        if name == "personal_data":
            assert ids == {r["doc_id"] for r in before}
            assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after)
            assert next(r["text"] for r in after if r["doc_id"] == 9005) == "write to [EMAIL] today please"
        if name == "mixture":
            words = lambda rs: sum(len(r["text"].split()) for r in rs)
            assert 1.2 * words(before) < words(after) < 1.8 * words(before)
            assert {(r["doc_id"], r["text"]) for r in after} <= {(r["doc_id"], r["text"]) for r in before}
        seen = out
    last = corpus_pipeline.STAGES[-1][1](spark, seen, "").collect()
    texts = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in seen.collect()}
    assert len(last) == seen.count()
    assert all(r["decoded_sha256"] == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in last)


def test_a_task_of_the_last_stage_holds_one_python_worker(spark, docs):
    plan = corpus_pipeline.STAGES[-1][1](spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan and "FlatMapGroupsInPandas" not in plan


def test_decoding_builds_no_vocabulary(monkeypatch):
    from mentionlake.llm import bpe
    from mentionlake.llm.plans import vocabulary

    monkeypatch.setattr(bpe, "Vocabulary", None)
    ranks, _ = vocabulary()
    assert sorted(bpe.spelled(ranks).items())[65][0] == 65 and b"".join(bpe.spelled(ranks)[i] for i in (0, 1))


def test_empty(spark, docs):
    seen = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, "")
    assert seen.count() == 0
