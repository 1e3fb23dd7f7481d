"""Gradient-boosted trees over binned features, and isotonic calibration, in numpy.

For samples of bounded size that one process holds; predictions are arrays, for use in workers.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 64


class Model(NamedTuple):
    """Complete binary trees of one depth, laid out in rows, and the calibration's steps."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float
    knots: np.ndarray
    values: np.ndarray


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nondecreasing least-squares fit by pooling neighbours; equal scores are one point."""
    knots, inverse = np.unique(score, return_inverse=True)
    weight = np.bincount(inverse).astype(float)
    mean = np.bincount(inverse, weights=label) / weight
    pools: list[list[float]] = []
    for x, m, w in zip(knots, mean, weight, strict=True):
        pools.append([m, w, x, x])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, _, hi = pools.pop()
            m1, w1, lo, _ = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, lo, hi])
    knots = np.array([x for p in pools for x in (p[2], p[3])])
    return knots, np.array([p[0] for p in pools for _ in (0, 1)])


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, least: float = 8.0) -> Model:
    """Boosted trees for the logistic loss; splits on the borders of quantile bins."""
    edges = [np.unique(np.quantile(f, np.linspace(0, 1, BINS + 1)[1:-1])) for f in x.T]
    binned = np.stack([np.searchsorted(e, f, side="left") for e, f in zip(edges, x.T, strict=True)], axis=1)
    share = min(max(y.mean(), 1e-4), 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(y), base)
    inner, n_features = (1 << depth) - 1, x.shape[1]
    feature, cut, leaf = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), dtype=np.int64)
        f_row, c_row = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width, first = 1 << level, (1 << level) - 1
            best = np.zeros(width)
            for f in range(n_features):
                cell = node * BINS + binned[:, f]
                g = np.bincount(cell, weights=gradient, minlength=width * BINS).reshape(width, BINS)
                h = np.bincount(cell, weights=hessian, minlength=width * BINS).reshape(width, BINS)
                gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
                gt, ht = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < least / 4) | (ht - hl < least / 4)] = 0
                gain[:, len(edges[f]) :] = 0
                at = gain.argmax(axis=1)
                for k in range(width):
                    if gain[k, at[k]] > best[k] + 1e-9:
                        best[k] = gain[k, at[k]]
                        f_row[first + k], c_row[first + k] = f, edges[f][at[k]]
            node = node * 2 + (x[np.arange(len(y)), f_row[first + node]] > c_row[first + node])
        g = np.bincount(node, weights=gradient, minlength=1 << depth)
        h = np.bincount(node, weights=hessian, minlength=1 << depth)
        value = rate * g / (h + 1)
        raw += value[node]
        feature.append(f_row)
        cut.append(c_row)
        leaf.append(value)
    return Model(np.array(feature), np.array(cut), np.array(leaf), base, np.zeros(0), np.zeros(0))


def raw_scores(model: Model, x: np.ndarray) -> np.ndarray:
    """Log-odds of each row."""
    total = np.full(len(x), model.base)
    rows = np.arange(len(x))
    depth = model.leaf.shape[1].bit_length() - 1
    for feature, cut, leaf in zip(model.feature, model.cut, model.leaf, strict=True):
        node = np.zeros(len(x), dtype=np.int64)
        for level in range(depth):
            at = (1 << level) - 1 + node
            node = node * 2 + (x[rows, feature[at]] > cut[at])
        total += leaf[node]
    return total


def probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    """Calibrated probabilities, between the calibration's steps in proportion."""
    raw = raw_scores(model, x)
    return np.interp(raw, model.knots, model.values) if len(model.knots) else 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray, **how) -> Model:
    """Trees from the rows not ``apart``, calibrated on those that are (on all if they lack a class)."""
    if len(np.unique(y[apart])) < 2 or len(np.unique(y[~apart])) < 2:
        apart = np.zeros(len(y), dtype=bool)
    model = fit_trees(x[~apart], y[~apart], **how) if len(y) else Model(np.zeros((0, 7), dtype=int), np.zeros((0, 7)), np.zeros((0, 8)), -4.0, np.zeros(0), np.zeros(0))
    calibrated = apart if apart.any() else ~apart
    if not len(y):
        return model
    knots, values = isotonic(raw_scores(model, x[calibrated]), y[calibrated])
    return model._replace(knots=knots, values=np.clip(values, 0.001, 0.999))
