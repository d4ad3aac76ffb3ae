"""64-bit hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20  # bytes hashed at a time
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# all of ASCII but letters and digits
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK)
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (BASE, INVERSE)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over all bits (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _block(data: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of one block; no word goes on beyond it."""
    gap = gaps[data]
    edge = np.diff(np.r_[True, gap, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.r_[np.uint64(0), np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)])]
        return starts, mix((total[ends] - total[starts]) * down[starts])


def hash_words(texts: list[str], gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text); A-Z count as a-z."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.cumsum([0, *(len(b) + 1 for b in raw)])
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    places, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and not gaps[data[end - 1]]:
            further = np.flatnonzero(gaps[data[end : end + BLOCK]])
            end = end + int(further[0]) + 1 if len(further) else min(end + BLOCK, len(data))
        starts, found = _block(data[at:end], gaps)
        places.append(starts + at)
        hashes.append(found)
        at = end
    if not places:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(places), offsets))
    return np.concatenate(hashes), counts
