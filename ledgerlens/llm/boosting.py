"""Boosted trees on a bounded sample, and isotonic calibration of their scores."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Binary boosted trees on binned features with logistic loss.

    Fitted on a sample that fits into memory; the model is a few arrays, so a task can score its
    own rows. ``fit`` is deterministic: ties go to the first feature and the lowest bin.
    """

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 32, least: int = 5):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        marks = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, marks)) if len(c) else np.zeros(0) for c in x.T]
        binned = self._binned(x)
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        self.grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        margin = np.full(len(y), self.start)
        for _ in range(self.trees if 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-margin))
            tree = self._tree(binned, y - p, p * (1 - p))
            self.grown.append(tree)
            margin += self.rate * self._leaf(tree, binned)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        cuts = [np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)]
        return np.stack(cuts, 1).astype(np.int64) if cuts else np.zeros((len(x), 0), np.int64)

    def _tree(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        nodes = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)
        at = np.zeros(len(g), np.int64)
        for level in range(self.depth + 1):
            first, count = 2**level - 1, 2**level
            local = at - first
            live = (local >= 0) & (local < count)
            gs = np.bincount(local[live], g[live], count)
            hs = np.bincount(local[live], h[live], count)
            value[first : first + count] = gs / (hs + 1.0)
            if level == self.depth:
                break
            best = np.full(count, 1e-6)
            for f in range(x.shape[1]):
                cell = local[live] * self.bins + x[live, f]
                gl = np.bincount(cell, g[live], count * self.bins).reshape(count, -1).cumsum(1)
                hl = np.bincount(cell, h[live], count * self.bins).reshape(count, -1).cumsum(1)
                nl = np.bincount(cell, minlength=count * self.bins).reshape(count, -1).cumsum(1)
                gr, hr, nr = gl[:, -1:] - gl, hl[:, -1:] - hl, nl[:, -1:] - nl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (gl[:, -1:] ** 2) / (hl[:, -1:] + 1)
                gain[(nl < self.least) | (nr < self.least)] = 0
                top = gain.argmax(1)
                won = gain[np.arange(count), top] > best
                best = np.where(won, gain[np.arange(count), top], best)
                feature[first : first + count][won] = f
                cut[first : first + count][won] = top[won]
            split = live & (feature[at] >= 0)
            right = x[split, feature[at[split]]] > cut[at[split]]
            at[split] = 2 * at[split] + 1 + right
        return feature, cut, value

    def _leaf(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            split = feature[at] >= 0
            right = x[split, feature[at[split]]] > cut[at[split]]
            at[split] = 2 * at[split] + 1 + right
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        out = np.full(len(x), self.start)
        for tree in self.grown:
            out += self.rate * self._leaf(tree, binned)
        return out


class Isotonic:
    """Non-decreasing map from margins to probabilities, by pooling adjacent violators.

    Between blocks the map is linear, and a small share of the plain logistic keeps rows of one
    block in the order of their margins.
    """

    def __init__(self, blend: float = 0.02):
        self.blend = blend

    def fit(self, margin: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(margin, kind="stable")
        blocks: list[list[float]] = []  # sum of labels, rows, sum of margins
        for m, label in zip(margin[order].tolist(), y[order].tolist(), strict=True):
            blocks.append([label, 1, m])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                top = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], top, strict=True)]
        self.at = np.array([b[2] / b[1] for b in blocks])
        self.value = np.array([b[0] / b[1] for b in blocks])
        return self

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        plain = 1 / (1 + np.exp(-margin))
        if len(self.at) == 0:
            return plain
        known = np.interp(margin, self.at, self.value)
        return (1 - self.blend) * known + self.blend * plain
