"""Gradient-boosted decision trees for binary labels, on NumPy arrays: a small histogram learner."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 32


class Trees(NamedTuple):
    """`cuts`: per feature the upper ends of its bins.  Per tree, in heap order: feature, bin and value of each node."""

    cuts: np.ndarray
    features: np.ndarray
    bins: np.ndarray
    values: np.ndarray
    start: float
    depth: int


def _binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    out = np.empty((x.shape[1], x.shape[0]), np.uint8)
    for f in range(x.shape[1]):
        out[f] = np.searchsorted(cuts[f], x[:, f], side="left")
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 100, depth: int = 6, rate: float = 0.2, seed: int = 0, rows: float = 0.35, columns: float = 0.35, least: float = 4.0) -> Trees:
    """Trees of a fixed depth by Newton steps on the logistic loss; each sees a share of rows and columns."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    cuts = np.full((width, BINS - 1), np.inf)
    for f in range(width):
        ends = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
        cuts[f, : len(ends)] = ends
    binned = _binned(x, cuts)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    nodes = (1 << depth) - 1
    features, bins, values = np.zeros((trees, nodes), np.int32), np.full((trees, nodes), 255, np.uint8), np.zeros((trees, 1 << depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        some = np.flatnonzero(rng.random(n) < rows)
        picked = rng.permutation(width)[: max(1, int(width * columns))]
        gs, hs = g[some], h[some]
        at = np.zeros(len(some), np.int64)  # position within the level
        for level in range(depth):
            wide = 1 << level
            best_gain, best_f, best_b = np.full(wide, 1e-3), np.zeros(wide, np.int64), np.full(wide, 255)
            for f in picked:
                code = at * BINS + binned[f][some]
                sg = np.bincount(code, gs, wide * BINS).reshape(wide, BINS).cumsum(1)
                sh = np.bincount(code, hs, wide * BINS).reshape(wide, BINS).cumsum(1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                gain[(sh < least) | (th - sh < least)] = -1
                b = gain.argmax(1)
                better = gain[np.arange(wide), b] > best_gain
                best_gain[better], best_f[better], best_b[better] = gain[np.arange(wide), b][better], f, b[better]
            base = wide - 1
            features[t, base : base + wide], bins[t, base : base + wide] = best_f, best_b
            at = at * 2 + (binned[best_f[at], some] > best_b[at])
        sg, sh = np.bincount(at, gs, 1 << depth), np.bincount(at, hs, 1 << depth)
        values[t] = -rate * sg / (sh + 1)
        score += _tree(binned, features[t], bins[t], values[t], depth)
    return Trees(cuts, features, bins, values, start, depth)


def _tree(binned: np.ndarray, feature: np.ndarray, bins: np.ndarray, values: np.ndarray, depth: int) -> np.ndarray:
    at = np.zeros(binned.shape[1], np.int64)
    every = np.arange(binned.shape[1])
    for level in range(depth):
        node = at + (1 << level) - 1
        at = at * 2 + (binned[feature[node], every] > bins[node])
    return values[at]


def log_odds(model: Trees, x: np.ndarray) -> np.ndarray:
    """The model's log-odds of the positive label for each row."""
    binned = _binned(x, model.cuts)
    out = np.full(len(x), model.start)
    for t in range(len(model.features)):
        out += _tree(binned, model.features[t], model.bins[t], model.values[t], model.depth)
    return out
