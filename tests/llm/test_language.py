"""Cross-parsing against a brute-force parse, and held-out accuracy."""

import re

import numpy as np
from pyspark.sql import functions as F

from mentionlake.llm import language
from mentionlake.llm.plans import op8_language


def brute(text, sample):
    """Phrases of ``text``: each the longest prefix of the rest that occurs in ``sample``."""
    count, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i : i + n + 1] in sample:
            n += 1
        count, i = count + 1, i + n
    return count


def test_phrases_equal_brute_force():
    rng = np.random.default_rng(2)
    samples = {lang: "".join(rng.choice(list("abcd ") if lang == "x" else list("bcde "), 300)) for lang in "xy"}
    samples = {k: language.normalise(v) for k, v in samples.items()}
    parsers = language.Parsers(samples)
    rows = ["".join(rng.choice(list("abcdeq "), n)) for n in (1, 5, 60, 400)] + ["", "!!", "A.b!C"]
    found, lengths = parsers.phrases(rows, parsers.codes())
    for i, row in enumerate(rows):
        text = re.sub("[^a-e q]+", " ", row.lower())
        text = re.sub(" +", " ", text) if language.normalise(row) else ""
        for j, lang in enumerate(parsers.languages):
            if text:
                assert found[i, j] == brute(text, samples[lang])
        assert (lengths[i] > 0) == bool(text)


def test_edges(frame):
    rows = [(1, "das ist ein haus und das ist gut", "de", 1), (2, "this is a house and it is good", "en", 2),
            (3, None, "de", 3), (4, "", "en", 4), (5, "123 !!", None, 5), (None, "this is good", "en", 6),
            (2, "this is a house and it is good", "en", 2), (7, "das haus " * 30_000, None, 7)]
    docs = frame(rows, "doc_id long, text string, lang string, score int")
    out = {(r["doc_id"], r["lang_pred"]) for r in language.identify(docs).collect()}
    assert out == {(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (7, "de")}
    assert language.identify(docs).count() == len(rows)
    assert language.identify(docs.where("false")).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs.where("lang is null")).collect()} == {"und"}


def test_training_takes_stretches_from_anywhere(frame, monkeypatch):
    """Long texts are learned from beyond their first characters, and many texts of one key are many rows."""
    monkeypatch.setattr(language, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(language, "TRAINING_CHARS", 4_000)
    rows = [(7, "z" * 3_000 + " das haus ist alt" * 300 + f" {i}", "de") for i in range(200)]
    rows += [(i, "z" * 3_000 + " the house is old" * 300, "en") for i in range(200)]
    docs = frame(rows, "doc_id long, text string, lang string")
    parsers = language.train(docs, F.lit(True), "doc_id", "text", "lang")
    assert parsers.predict(["das haus ist alt", "the house is old"], parsers.codes())[0] == ["de", "en"]
    assert all(2**bits < 2 * language.TRAINING_CHARS for bits in parsers.bits)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = op8_language(spark, folder).join(docs, "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_every_letter_of_many_scripts_counts(monkeypatch):
    """Letters of all training texts are told apart, in the dense table or not."""
    scripts = {"ar": (0x627, 28), "el": (0x3B1, 24), "en": (0x61, 26), "he": (0x5D0, 27), "hi": (0x905, 50), "hy": (0x561, 38), "ja": (0x3042, 80),
               "ka": (0x10D0, 33), "ko": (0xAC00, 1500), "ru": (0x430, 32), "th": (0xE01, 46), "zh": (0x4E00, 3000)}
    rng = np.random.default_rng(7)

    def text(lang, n):
        first, size = scripts[lang]
        p = 1 / np.arange(1, size + 1)
        return language.normalise("".join(map(chr, np.where(rng.random(n) < 0.15, 32, first + rng.choice(size, n, p=p / p.sum())))))

    samples = {lang: text(lang, 3000) for lang in scripts}
    rows, want = [text(lang, 200) for lang in scripts], list(scripts)
    for table in (language.TABLE, 1):
        monkeypatch.setattr(language, "TABLE", table)
        parsers = language.Parsers(samples)
        assert set("".join(samples.values())) - {" "} == set(parsers.symbols)
        found, _ = parsers.phrases(rows, parsers.codes())
        assert found.tolist() == [[brute(row, samples[lang]) for lang in parsers.languages] for row in rows]
        assert parsers.predict(rows, parsers.codes())[0] == want
