"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built from a bounded sample of labelled text: a stretch of each of its
``SAMPLE_ROWS`` rows, at a place given by a hash, ``TRAINING_CHARS`` in all. A text is parsed
against every automaton into phrases, each the longest match that starts where the last one ended; the
language whose automaton needs the fewest phrases, normalised to bits per character by the size of its
training text, wins (ties: the smaller name). Texts are lower-cased and every run of non-letters is one
blank. Long texts are parsed in segments of ``SEGMENT`` characters, so one text is many short parses.

Null texts and texts without a letter are ``und`` with score 0, as is everything when no labelled text
exists. Rows with a null key are predicted but never learned from; repeated rows stay repeated; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.llm.common import parts, ready, share, texts, tidy
from mentionlake.session import materialize, small_side

SAMPLE_ROWS = 200  # labelled rows of a language that are learned from, about
TRAINING_CHARS = 30_000  # characters of a language in its automaton, about; spread over its rows
TABLE = 20_000_000  # entries of the dense table, about; decides how many letters of a language are in it, not results
SEGMENT = 512
PART_CHARS = 500_000  # characters parsed at a time
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter; built once in each Python worker."""
    if not _letters:
        _letters.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    return _letters[0]


def normalise(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``codes``; state 0 is the start."""
    arcs: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        new = len(arcs)
        arcs.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in arcs[p]:
            arcs[p][c] = new
            p = link[p]
        if p >= 0:
            q = arcs[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(arcs)
                arcs.append(dict(arcs[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = twin
                while p >= 0 and arcs[p].get(c) == q:
                    arcs[p][c] = twin
                    p = link[p]
        last = new
    return arcs


class Parsers:
    """The automata of all languages: a dense table for each language's most frequent letters, sorted arcs for others.

    Every letter of every training text has a symbol. An entry is twice the table offset of the next state, plus
    one if a phrase ended before the character. Column 0 is the blank, the last one any letter that the language's
    text lacks; a letter outside the dense table has a number instead, and its arcs are found by offset and number.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(lang for lang, text in samples.items() if text.strip())
        self.symbols = {c: i + 1 for i, c in enumerate(sorted({c for lang in self.languages for c in samples[lang]} - {" "}))}
        coded = [[0 if c == " " else self.symbols[c] for c in samples[lang]] for lang in self.languages]
        automata = [suffix_automaton(codes) for codes in coded]
        letters = [[c for c, _ in sorted(Counter(codes).items(), key=lambda e: (-e[1], e[0])) if c] for codes in coded]
        common = max(8, TABLE // max(1, sum(map(len, automata))) - 2)
        common = min(common, max(map(len, letters), default=0))
        self.width = common + 2
        # column and number of each symbol in each language
        self.columns = np.full((len(coded), len(self.symbols) + 2), common + 1, np.int32)
        self.numbers = np.zeros_like(self.columns)
        self.columns[:, 0] = 0
        self.span = max(map(len, letters), default=0) + 1
        tables, keys, nexts, starts, self.roots, self.bits, states = [], [], [], [], [], [], 0
        for codes, arcs, known, column, number in zip(coded, automata, letters, self.columns, self.numbers):
            column[known[:common]] = np.arange(1, len(known[:common]) + 1)
            number[known[common:]] = np.arange(1, len(known[common:]) + 1)
            root = states * self.width
            alone = states + len(arcs)  # reached by a letter that no phrase can hold
            entries = np.full((len(arcs) + 1, self.width), 2 * alone * self.width + 1, np.int64)
            entries[0] -= 1
            at = np.repeat(np.arange(len(arcs)), [len(a) for a in arcs])
            symbol = np.array([c for a in arcs for c in a], np.int64)
            to = 2 * (states + np.array([t for a in arcs for t in a.values()], np.int64)) * self.width
            rare = number[symbol] > 0
            first = (at == 0) & ~rare
            entries[1:, column[symbol[first]]] = to[first] + 1
            entries[at[~rare], column[symbol[~rare]]] = to[~rare]
            tables.append(entries.ravel())
            keys.append((states + at[rare]) * self.width * self.span + number[symbol[rare]])
            nexts.append(to[rare])
            begin = np.zeros(self.span, np.int64)  # of a phrase that starts with a numbered letter
            begin[number[symbol[rare & (at == 0)]]] = to[rare & (at == 0)]
            starts.append(begin)
            self.roots.append(root)
            self.bits.append(math.log2(max(2, len(codes))))
            states += len(arcs) + 1
        kind = np.int32 if 2 * states * self.width < 2**31 else np.int64
        self.table = np.concatenate(tables).astype(kind) if tables else np.empty(0, kind)
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(self.keys)
        self.keys, self.nexts = self.keys[order], np.concatenate(nexts)[order] if nexts else np.empty(0, np.int64)
        self.starts = np.stack(starts) if starts else np.empty((0, 1), np.int64)

    def codes(self) -> np.ndarray:
        """Symbol of each code point; the last one is any letter of no training text."""
        table = np.where(letter_table(), len(self.symbols) + 1, 0).astype(np.int32)
        for c, i in self.symbols.items():
            table[ord(c)] = i
        return table

    def numbered(self, state: np.ndarray, number: np.ndarray, entry: np.ndarray) -> None:
        """Set the entries of letters that are not in the dense table."""
        lang, text = np.nonzero(number)
        if len(lang):
            which = number[lang, text]
            key = state[lang, text] * self.span + which
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            entry[lang, text] = np.where(self.keys[at] == key, self.nexts[at], self.starts[lang, which] + 1)

    def phrases(self, rows: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases by text and language, normalised length of each text; 0: no letter)."""
        lowered = [t.lower() for t in rows]
        sizes = np.fromiter(map(len, lowered), np.int64, len(rows))
        symbol = codes[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)]
        own = np.repeat(np.arange(len(rows)), sizes)
        blank = symbol == 0
        first = np.r_[True, own[1:] != own[:-1]][: len(own)]
        keep = ~blank | (~first & ~np.r_[False, blank[:-1]][: len(own)])
        symbol, own, blank = symbol[keep], own[keep], blank[keep]
        lengths = np.bincount(own, minlength=len(rows))
        letters = np.bincount(own[~blank], minlength=len(rows))
        offsets = np.r_[0, np.cumsum(lengths)]
        parts = -(-lengths // SEGMENT)
        text = np.repeat(np.arange(len(rows)), parts)
        number = np.arange(len(text)) - np.repeat(np.r_[0, np.cumsum(parts)][:-1], parts)
        start = offsets[text] + number * SEGMENT
        size = np.minimum(SEGMENT, offsets[text + 1] - start)
        order = np.argsort(-size, kind="stable")
        text, start, size = text[order], start[order], size[order]
        total = np.zeros((len(self.languages), len(text)), np.int32)
        state = np.repeat(np.array(self.roots, np.int64)[:, None], len(text), axis=1)
        columns, numbers = self.columns[:, symbol], self.numbers[:, symbol]
        rare = numbers.any()
        active = np.searchsorted(-size, -np.arange(SEGMENT), side="left")
        for t in range(int(size[0]) if len(size) else 0):
            m = active[t]
            at = start[:m] + t
            entry = self.table.take(state[:, :m] + columns[:, at])
            if rare:
                self.numbered(state[:, :m], numbers[:, at], entry)
            total[:, :m] += entry & 1
            state[:, :m] = entry >> 1
        total += state != np.array(self.roots)[:, None]
        found = np.zeros((len(rows), len(self.languages)), np.int64)
        np.add.at(found, text, total.T)
        return found, np.where(letters > 0, lengths, 0)

    def predict(self, rows: list[str], codes: np.ndarray) -> tuple[list[str], np.ndarray]:
        found, lengths = self.phrases(rows, codes)
        entropy = found * np.array(self.bits) / np.maximum(lengths, 1)[:, None]
        if not self.languages:
            return [UNKNOWN] * len(rows), np.zeros(len(rows))
        best = np.argmin(entropy, axis=1)
        ranked = np.sort(entropy, axis=1)
        least = ranked[:, 0]
        second = ranked[:, 1] if ranked.shape[1] > 1 else np.full(len(rows), np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(np.isinf(second), 1.0, second / (least + second))
        known = lengths > 0
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
        return names, np.where(known, np.nan_to_num(score, nan=0.5), 0.0)


def train(docs: DataFrame, learn: Column, key: str, text: str, lang: str) -> Parsers:
    """Automata from about ``SAMPLE_ROWS`` rows of each language among those where ``learn`` holds.

    Rows are picked by a hash of key and text where they lie, so many texts of one key are many rows; only a
    stretch of each travels, from anywhere in the text, as long as needed for ``TRAINING_CHARS`` of its language.
    """
    usable = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = materialize(usable.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    size = F.ceil(TRAINING_CHARS / F.least("rows", F.lit(SAMPLE_ROWS))).cast("int")
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - size + 1, F.lit(1))).cast("int") + 1
    rows = (
        usable.join(small_side(counts, counts.count()), "lang").where(share("key", F.col("rows"), SAMPLE_ROWS, "text"))
        .select("lang", F.xxhash64("key", "text").alias("place"), F.substring("text", start, size).alias("text"))
        .distinct().collect()
    )
    samples: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"], r["text"])):
        samples.setdefault(row["lang"], []).append(normalise(row["text"]))
    return Parsers({k: " ".join(v) for k, v in samples.items()})


def identify(
    docs: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """(key, lang_pred, score) of every row; learns from rows where ``learn`` holds."""
    spark = ready(docs.sparkSession)
    parsers = train(docs, F.lit(True) if learn is None else learn, key, text, lang)
    return apply(docs, spark.sparkContext.broadcast(parsers), [key], text)


def apply(
    docs: DataFrame, parsers, keep: list[str], text: str = "text", into: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with language and score of its texts. ``parsers`` is a broadcast."""
    names = list(keep)
    rows = docs.select(*names, *([] if text in names else [text]))
    at = rows.columns.index(text)

    def predicted(batches):
        codes = None
        for batch, part in texts(batches, at):
            codes = parsers.value.codes() if codes is None else codes
            told = [parsers.value.predict(rows, codes) for rows in parts(part, PART_CHARS)]
            found, score = [x for tags, _ in told for x in tags], np.concatenate([s for _, s in told])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(found, pa.string()), pa.array(score)],
                [*names, *into],
            )

    kept = rows.select(*names).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return rows.mapInArrow(tidy(predicted), f"{schema}, {into[0]} string, {into[1]} double")


def recognised(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in some language."""
    spark = ready(docs.sparkSession)
    parsers = spark.sparkContext.broadcast(train(docs, F.lit(True), key, text, lang))
    told = apply(docs, parsers, docs.columns, text, into=("__lang", "__score"))
    return told.where(F.col("__lang") != UNKNOWN).select(*docs.columns)
