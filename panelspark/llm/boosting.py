"""Gradient-boosted regression trees for the logistic loss, on small training sets, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A complete binary tree: node i has children 2i + 1 and 2i + 2; rows with x[feature] > cut go right."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def apply(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.cut[at])
        return self.value[at - (2**self.depth - 1)]


@dataclass
class Model:
    base: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.apply(x)
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, share: float = 0.5, seed: int = 1) -> Model:
    """Trees are grown level by level on quantile bins of each feature, by the gain of second-order sums over a share of the rows."""
    x = x.astype(np.float32)
    features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(features)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Model(float(np.log(p0 / (1 - p0))), [])
    margin, draw = np.full(len(y), model.base), np.random.default_rng(seed)
    offset = np.arange(features) * bins
    for _ in range(trees):
        rows = np.flatnonzero(draw.random(len(y)) < share)
        p = 1 / (1 + np.exp(-margin[rows]))
        g, h = p - y[rows], p * (1 - p)
        some, values = binned[rows], x[rows]
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf, np.float32)
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            key = ((at - first)[:, None] * (features * bins) + offset + some).ravel()
            shape = (width, features, bins)
            gs = np.bincount(key, np.repeat(g, features), minlength=width * features * bins).reshape(shape).cumsum(axis=2)
            hs = np.bincount(key, np.repeat(h, features), minlength=width * features * bins).reshape(shape).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    feature[first + k], cut[first + k] = j, cuts[j][b]
            at = 2 * at + 1 + (values[np.arange(len(rows)), feature[at]] > cut[at])
        leaf = at - (2**depth - 1)
        gl, hl = np.bincount(leaf, g, minlength=2**depth), np.bincount(leaf, h, minlength=2**depth)
        tree = Tree(feature, cut, -rate * gl / (hl + ridge), depth)
        model.trees.append(tree)
        margin += tree.apply(x)
    return model
