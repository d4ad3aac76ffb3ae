"""Personal data: base patterns, and further spans chosen by boosted trees.

Base spans are the leftmost non-overlapping matches of a fixed pattern for each kind that pass its
check; matches that fail are dropped whole. On top, high-recall generators propose overlapping spans:
every window of digit or dotted groups that could be a card, phone or address, and every word around an
at sign. Boosted trees score them by format and context. There are no labels, so they are made: in a bounded
sample of the corpus base spans are taken out and ``PLANTED`` made-up pieces are put in, half of them personal
data, alone or side by side, half of them corrupted (wrong check digit, wrong length, glued to other
characters, parts out of range). What was put in whole is true, every other candidate of these texts is not;
so the trees see the corpus' own versions, hashes and numbers as what to leave alone. Probabilities are
calibrated on texts held out, for each kind, and a candidate is selected from ``THRESHOLD`` on,
best first, if it overlaps neither a base span nor a selected one of its kind. So two adjacent card
numbers, which the base pattern reads as one too long number, are both found.

Null and empty texts have no spans; positions are code points, ends exclusive; repeated rows stay
repeated; other columns are ignored or, in ``redact``, kept.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mentionlake.llm.boosting import Boosted, Isotonic
from mentionlake.llm.common import ready, share, texts, tidy

# Kinds in the order that breaks ties, and the patterns of the contract.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE_TEXTS = 3_000  # texts with a digit or an at sign that may be learned from; they are taken whole
SAMPLE_CANDIDATES = 60_000  # candidates of them that are learned from, spread evenly over all
PLANTED = 8  # pieces put into each of them
THRESHOLD = 0.95  # calibrated probability from which a candidate is selected
MOST_DIGITS = 19  # of any kind; no candidate has more
PART = 20_000  # candidates that are scored at a time

ANY = re.compile("[0-9@]")
DIGITS = re.compile("[0-9]+")
RUN = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*")
AT_WORD = re.compile(r"@[A-Za-z0-9.-]*[A-Za-z0-9]")
HINTS = re.compile(r"(?i)mail|tel|phone|fon|call|card|visa|ip\b|addr|token|key|sha|version|isbn")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def valid_card(text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def valid_phone(text: str) -> bool:
    return 10 <= sum(c.isdigit() for c in text) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, at sign and dotted domain: the at signs are visited once, from the left."""
    done = 0
    for m in DOMAIN.finditer(text):
        head = text[done : m.start()]
        start = done + len(head.rstrip(LOCAL))
        if start < m.start():
            yield start, m.end()
            done = m.end()
        else:
            done = m.start() + 1


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    if not ANY.search(text):
        return []
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text) if valid_ip(m.group())]
    found += [("card", *m.span()) for m in CARD.finditer(text) if valid_card(m.group())]
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if valid_phone(m.group())]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> Iterator[Span]:
    """Overlapping spans that may be personal data, all of at most ``MOST_DIGITS`` digits however grouped."""
    if not ANY.search(text):
        return
    if "@" in text:
        done = 0
        for m in AT_WORD.finditer(text):
            start = done + len(text[done : m.start()].rstrip(LOCAL))
            if start < m.start():
                yield "email", start, m.end()
            done = m.start() + 1
    for run in RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [(a + run.start(), b + run.start()) for a, b in (m.span() for m in DIGITS.finditer(run.group()))]
        for i, (start, _) in enumerate(groups):
            digits = 0
            for j in range(i, len(groups)):
                end = groups[j][1]
                digits += end - groups[j][0]
                if digits > MOST_DIGITS:
                    break
                if j == i + 3 and end - start == digits + 3 and text.count(".", start, end) == 3:
                    yield "ip", start, end
                if digits >= 13:
                    yield "card", start, end
                if 7 <= digits <= 15 and j > i:
                    yield "phone", start - (text[start - 1 : start] == "+"), end


def check_digit(digits: str) -> str:
    return next(c for c in "0123456789" if luhn(digits + c))


def made_up(kind: str, rng: random.Random) -> str:
    """Personal data of a kind, in one of its usual forms."""
    def digits(n: int) -> str:
        return "".join(rng.choices("0123456789", k=n))

    def word() -> str:
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))

    if kind == "email":
        return word() + rng.choice(["", ".", "_", "+"]) + word() + "@" + word() + "." + rng.choice(["com", "org", "net", "co.uk", "de"])
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        number = rng.choice("3456") + digits(rng.choice([12, 13, 14, 14, 14, 14, 15, 17]))
        number += check_digit(number)
        gap = rng.choice(["", "", " ", "-"])
        sizes = [4, 6, 5] if len(number) == 15 else [4] * 5
        starts = [sum(sizes[:i]) for i in range(len(sizes))]
        return gap.join(filter(None, (number[s : s + n] for s, n in zip(starts, sizes))))
    gap = rng.choice([" ", "-", "."])
    area = rng.choice(["({})", "{}"]).format(digits(3))
    return f"+{rng.randint(1, 99)}{rng.choice([' ', '-'])}{area}{rng.choice([gap, ' '])}{digits(3)}{gap}{digits(rng.choice([4, 4, 5]))}"


def corrupted(kind: str, rng: random.Random) -> str:
    """What looks like personal data of a kind and is not."""
    good = made_up(kind, rng)
    way = rng.randrange(3)
    if way == 0:  # part of something longer
        glue = "".join(rng.choices("0123456789abcdef", k=rng.randint(3, 9))) + rng.choice("abcdef")
        return glue + good if kind != "email" else good.partition("@")[0] + "@" + glue
    if kind == "email":
        return good.replace(".", "")
    if kind == "ip":
        return f"{good}.{rng.randint(0, 99)}" if way == 1 else good.rpartition(".")[0] + f".{rng.randint(256, 9999)}"
    if kind == "card":
        return good[:-1] + str((int(good[-1]) + rng.randint(1, 9)) % 10) if way == 1 else good[:-5]
    return good[1:] if way == 1 else good[:-6]


def planted(text: str) -> tuple[str, set[Span]]:
    """``text`` without its base spans but with made-up pieces, and where the true ones are."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    out, at = [], 0
    for _, start, end in base_spans(text):
        if start >= at:
            out.append(text[at:start])
        at = max(at, end)
    plain = "".join([*out, text[at:]])
    blanks = [m.start() for m in re.finditer(r"\s", plain)] or [len(plain)]
    places = sorted(rng.choices(blanks, k=PLANTED))
    true, made, size, at = set(), [], 0, 0
    for place in places:
        kinds = rng.choices(KINDS, k=rng.choice([1, 1, 2, 3]))
        kinds = kinds[:1] * len(kinds) if rng.random() < 0.5 else kinds
        pieces = [(k, made_up(k, rng)) for k in kinds] if rng.random() < 0.5 else [("", corrupted(kinds[0], rng))]
        made.append(plain[at:place] + rng.choice([" ", " ", ": ", " (", ", "]))
        size, at = size + len(made[-1]), place
        for kind, piece in pieces:
            if kind:
                true.add((kind, size, size + len(piece)))
            made.append(piece + rng.choice([" ", " ", " ", ", "]))
            size += len(made[-1])
    return "".join([*made, plain[at:]]), true


def features(text: str, span: Span) -> list[float]:
    """Format of a span and of what stands around it."""
    kind, start, end = span
    inside, before, after = text[start:end], text[start - 1 : start], text[end : end + 1]
    digits = [c for c in inside if "0" <= c <= "9"]
    groups = DIGITS.findall(inside)
    tail = inside.rpartition("@")[2] if kind == "email" else ""
    hint = HINTS.search(text[max(0, start - 24) : start])
    return [
        end - start, len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(digits)), inside.count(" "), inside.count("-"), inside.count("."), inside.count("("),
        inside[0] == "+", bool(digits) and luhn("".join(digits[:24])),
        max((min(999, int(g[:4])) for g in groups), default=0), tail.count("."), len(tail.rpartition(".")[2]),
        before.isalpha(), before.isdigit(), before in "+-.@" and bool(before), before.isspace() or not before,
        after.isalpha(), after.isdigit(), after in "-.@" and bool(after), after.isspace() or not after,
        -1 if hint is None else len(hint.group()), KINDS.index(kind),
    ]


class Taken:
    """Stretches of a text that do not overlap."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.spans = sorted(spans)

    def free(self, start: int, end: int) -> bool:
        i = bisect_left(self.spans, (end, 0))
        return i == 0 or self.spans[i - 1][1] <= start

    def add(self, start: int, end: int) -> None:
        insort(self.spans, (start, end))


class Detector:
    """Boosted trees over planted examples with a calibration for each kind; without examples of both sorts it selects nothing."""

    def __init__(self, sample: list[str]):
        sown = [planted(text) for text in sample]
        step = -(-sum(1 for text, _ in sown for _ in candidates(text)) // SAMPLE_CANDIDATES) or 1
        every = ((i, text, c, c in true) for i, (text, true) in enumerate(sown) for c in candidates(text))
        rows = [(i, true, features(text, c)) for i, text, c, true in islice(every, 0, None, step)]
        self.model, self.calibrated = None, {}
        y = np.array([r[1] for r in rows], float)
        held = np.array([r[0] % 4 == 0 for r in rows], bool)
        if len(rows) < 40 or not 0 < y[~held].sum() < (~held).sum():
            return
        x = np.array([r[2] for r in rows], float)
        self.model = Boosted(x[~held], y[~held])
        score = self.model.score(x[held])
        for k, kind in enumerate(KINDS):
            own = x[held][:, -1] == k
            if y[held][own].any():
                self.calibrated[kind] = Isotonic(score[own], y[held][own])

    def added(self, text: str, base: list[Span], threshold: float = THRESHOLD) -> list[Span]:
        """Selected spans beside the base ones."""
        if self.model is None:
            return []
        taken = {kind: Taken((a, b) for k, a, b in base if k == kind) for kind in KINDS}
        free = (c for c in candidates(text) if c[0] in self.calibrated and taken[c[0]].free(c[1], c[2]))
        likely: list[tuple[float, int, Span]] = []
        while part := list(islice(free, PART)):
            score = self.model.score(np.array([features(text, c) for c in part], float))
            kinds = np.array([KINDS.index(c[0]) for c in part])
            chance = np.zeros(len(part))
            for k, kind in enumerate(KINDS):
                if (own := kinds == k).any():
                    chance[own] = self.calibrated[kind](score[own])
            likely += [(-score[i], part[i][1] - part[i][2], part[i]) for i in np.flatnonzero(chance >= threshold)]
        chosen = []
        for _, _, (kind, start, end) in sorted(likely):
            if taken[kind].free(start, end):
                taken[kind].add(start, end)
                chosen.append((kind, start, end))
        return chosen


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Detector:
    """A detector from at most ``SAMPLE_TEXTS`` texts, picked by a hash of their key.

    They are told apart from the rest where they lie, so only they travel, however many tasks there are.
    """
    usable = docs.where(F.col(text).rlike("[0-9@]"))
    rows = (
        docs.where(share(key, F.lit(usable.count()), SAMPLE_TEXTS)).where(F.col(text).rlike("[0-9@]"))
        .select(F.xxhash64(key).alias("place"), F.col(text).alias("text"))
        .orderBy("place", "text")
        .limit(SAMPLE_TEXTS)
        .collect()
    )
    return Detector([r["text"] for r in rows])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans) of every row; counts are of base spans."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fit(docs, key, text))
    kind = docs.schema[key].dataType.simpleString()

    def found(batches):
        for batch, part in texts(batches):
            base = [base_spans(t) for t in part]
            every = [sorted(b + shared.value.added(t, b), key=lambda s: (s[1], KINDS.index(s[0])))
                     for t, b in zip(part, base)]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(map(joined, base), pa.string()), pa.array(map(joined, every), pa.string())],
                ["key", *(f"n_{k}" for k in KINDS), "base", "spans"],
            )

    schema = f"key {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, spans string"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(found, schema).withColumnRenamed("key", key)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each stretch of overlapping spans replaced by the name of its first kind."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with personal data in its texts masked; all columns stay as they are."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fit(docs, key, text))
    names = docs.columns
    at = names.index(text)

    def cleaned(batches):
        for batch, part in texts(batches, at):
            out = []
            for value, t in zip(batch.column(at), part):
                base = base_spans(t)
                spans = sorted(base + shared.value.added(t, base), key=lambda s: (s[1], KINDS.index(s[0])))
                out.append(None if not value.is_valid else masked(t, spans))
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(tidy(cleaned), docs.schema)
