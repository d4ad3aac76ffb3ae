"""Encoding against the tiktoken library, and the exact round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from mentionlake.llm import bpe
from mentionlake.llm.plans import op1_bpe, vocabulary

TEXTS = [
    "", None, " ", "a", "It's  the   end\n\n\n of 'llama' we'RE  ", "x" * 5000, "=" * 700 + "\t" * 900, "ünïcödé 漢字 🙂🙂 123 4567",
    "   mixed 　 spaces \r\n", "don't " * 900, "word " * 3000 + "z" * 4000 + " tail's", "  \n" * 2000 + "e",
]


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_the_library(reference):
    v = bpe.Vocabulary(*vocabulary())
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdeéß漢 =1") for _ in range(rng.randint(1, 90))) for _ in range(400)]
    got = v.encode_pieces([[p] for p in pieces])
    assert [g.tolist() for g in got] == [
        [i for i in reference._core_bpe.encode_single_piece(p.encode())] for p in pieces
    ]


def test_stitching_equals_one_pass():
    v = bpe.Vocabulary(*vocabulary())
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["word", " ", "  ", "\n", "'re", "'", "'ll", "123", "é", "==", "\t\t", "x" * 50]) for _ in range(300))
        size, overlap = rng.randint(20, 200), rng.randint(4, 60)
        chunks = []
        for s in range(0, len(text), size):
            e = min(len(text), s + size + overlap)
            chunks.append((s, e, bpe.boundaries(v.find, text[s:e]) + s))
        assert np.array_equal(bpe.stitch(v.find, text, chunks), bpe.boundaries(v.find, text))


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (64, 16)])
def test_whole_texts(frame, reference, chunk, overlap):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(3, TEXTS[4], 8), (10, TEXTS[10], 9), (None, "no id", 1)]
    docs = frame(rows, "doc_id long, text string, ids int")
    ranks, pattern = vocabulary()
    out = bpe.decode(bpe.encode(docs, ranks, pattern, chunk=chunk, overlap=overlap), ranks, pattern).collect()
    want = sorted((str(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"]), bytes(r["decoded"])) for r in out) == want


def test_empty_table(frame):
    docs = frame([], "doc_id long, text string")
    assert bpe.encode(docs, *vocabulary()).count() == 0


def test_query(spark, reference):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = op1_bpe(spark, folder).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = reference.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
