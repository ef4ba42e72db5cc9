"""Gradient boosted trees over tables of discrete features with row counts.

The rows of a corpus collapse to the feature vectors that occur and how often,
a table whose size depends on the features alone, so a fit on it is a fit on
the whole corpus. Fitted trees become a Spark expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Split:
    """``feature`` <= ``limit`` goes left; a leaf has a ``value`` only."""

    value: float = 0.0
    feature: int = -1
    limit: int = 0
    left: Split | None = None
    right: Split | None = None


@dataclass
class Boosted:
    base: float
    trees: list[Split]
    #: Platt's scaling of the margins.
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        def run(t: Split, at: np.ndarray, out: np.ndarray) -> None:
            if t.left is None or t.right is None:
                out[at] += t.value
                return
            low = x[at, t.feature] <= t.limit
            run(t.left, at[low], out)
            run(t.right, at[~low], out)

        out = np.full(len(x), self.base)
        for t in self.trees:
            run(t, np.arange(len(x)), out)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -500, 500)))

    def column(self, features: list[Column]) -> Column:
        """The calibrated probability as an expression."""

        def expr(t: Split) -> Column:
            if t.left is None or t.right is None:
                return F.lit(float(t.value))
            return F.when(features[t.feature] <= t.limit, expr(t.left)).otherwise(expr(t.right))

        total = F.lit(float(self.base))
        for t in self.trees:
            total = total + expr(t)
        return 1 / (1 + F.exp(-(total * F.lit(float(self.slope)) + F.lit(float(self.shift)))))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, l2: float) -> Split:
    best, gain = None, 1e-9
    whole = g.sum() ** 2 / (h.sum() + l2)
    if depth and len(x) > 1:
        for f in range(x.shape[1]):
            for limit in np.unique(x[:, f])[:-1]:
                low = x[:, f] <= limit
                gl, hl = g[low].sum(), h[low].sum()
                now = gl**2 / (hl + l2) + (g.sum() - gl) ** 2 / (h.sum() - hl + l2) - whole
                if now > gain:
                    best, gain = (f, int(limit)), now
    if best is None:
        return Split(value=-g.sum() / (h.sum() + l2))
    low = x[:, best[0]] <= best[1]
    return Split(0.0, *best, _grow(x[low], g[low], h[low], depth - 1, l2), _grow(x[~low], g[~low], h[~low], depth - 1, l2))


def fit(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, *, trees: int = 20, depth: int = 3, rate: float = 0.3, l2: float = 1.0) -> Boosted:
    """Boost the logistic loss of feature vectors seen ``pos`` and ``neg`` times."""
    n = pos + neg
    p = (pos.sum() + 0.5) / (n.sum() + 1)
    model = Boosted(float(np.log(p / (1 - p))), [])
    m = np.full(len(x), model.base)
    for _ in range(trees):
        q = 1 / (1 + np.exp(-m))
        tree = _grow(x, n * q - pos, np.maximum(n * q * (1 - q), 1e-9), depth, l2)
        tree = _scaled(tree, rate)
        model.trees.append(tree)
        m += Boosted(0.0, [tree]).margin(x)
    return model


def _scaled(t: Split, rate: float) -> Split:
    if t.left is None or t.right is None:
        return Split(value=t.value * rate)
    return Split(0.0, t.feature, t.limit, _scaled(t.left, rate), _scaled(t.right, rate))


def calibrate(model: Boosted, x: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> Boosted:
    """Platt's scaling on rows that the fit has not seen."""
    m, a, b = model.margin(x), 1.0, 0.0
    n = pos + neg
    if not pos.sum() or not neg.sum():
        return model
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        r, w = n * q - pos, n * q * (1 - q) + 1e-9
        grad = np.array([(r * m).sum() + 1e-3 * (a - 1), r.sum()])
        hess = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Boosted(model.base, model.trees, float(a), float(b))


def threshold(p: np.ndarray, pos: np.ndarray, neg: np.ndarray, precision: float) -> float:
    """The smallest probability from which on the rows are right in at least
    the share ``precision``; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum(pos[order]), np.cumsum((pos + neg)[order])
    good = np.flatnonzero((hit >= precision * all_) & (hit > 0) & np.append(np.diff(p[order]) != 0, True))
    return float(p[order][good[-1]]) - 1e-12 if len(good) else 1.1
