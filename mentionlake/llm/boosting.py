"""Gradient boosted trees on binned features, with probabilities calibrated on held-out rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for part, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            part.append(empty)
        return len(self.feature) - 1

    def predict(self, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), np.int64)
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(binned[rows, feature[node]] <= cut[node], left[node], right[node])
        return np.array(self.value)[at]


def fit_tree(binned: np.ndarray, slope: np.ndarray, weight: np.ndarray, depth: int, smooth: float = 1.0) -> Tree:
    """A tree that lowers a second-order loss: ``slope`` and ``weight`` are its derivatives by row."""
    tree = Tree()
    open_nodes = [(tree.add(), np.arange(len(binned)), depth)]
    while open_nodes:
        node, rows, levels = open_nodes.pop()
        g, h = slope[rows].sum(), weight[rows].sum()
        tree.value[node] = -g / (h + smooth)
        if not levels or len(rows) < 4:
            continue
        best = (1e-6, -1, 0)
        for f in range(binned.shape[1]):
            gl = np.cumsum(np.bincount(binned[rows, f], slope[rows], BINS))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, f], weight[rows], BINS))[:-1]
            gain = gl**2 / (hl + smooth) + (g - gl) ** 2 / (h - hl + smooth) - g**2 / (h + smooth)
            k = int(np.argmax(gain))
            best = max(best, (float(gain[k]), f, k), key=lambda x: x[0])
        if best[1] < 0:
            continue
        _, tree.feature[node], tree.cut[node] = best
        goes_left = binned[rows, best[1]] <= best[2]
        tree.left[node], tree.right[node] = tree.add(), tree.add()
        open_nodes += [(tree.left[node], rows[goes_left], levels - 1), (tree.right[node], rows[~goes_left], levels - 1)]
    return tree


class Boosted:
    """Boosted trees for a yes or no question."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start, self.rate = float(np.log(share / (1 - share))), rate
        self.trees: list[Tree] = []
        binned, score = self.bins(x), np.full(len(x), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            self.trees.append(fit_tree(binned, p - y, p * (1 - p), depth))
            score += rate * self.trees[-1].predict(binned)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = self.bins(x)
        return self.start + self.rate * sum(t.predict(binned) for t in self.trees)


class Isotonic:
    """Score to probability, never falling (pool adjacent violators)."""

    def __init__(self, score: np.ndarray, y: np.ndarray):
        blocks: list[list[float]] = []
        for s, v in sorted(zip(score.tolist(), y.tolist())):
            blocks.append([s, v, 1.0])
            while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
                _, v, n = blocks.pop()
                blocks[-1][1] += v
                blocks[-1][2] += n
        self.at = np.array([b[0] for b in blocks])
        self.p = np.array([b[1] / b[2] for b in blocks])

    def __call__(self, score: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.zeros(len(score))
        return np.where(score < self.at[0], 0.0, self.p[np.searchsorted(self.at, score, side="right") - 1])
