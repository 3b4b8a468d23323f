"""A generalised additive model with pairwise interactions, learned by cyclic boosting.

Every feature is cut into bins. In turn, each feature gets a shallow tree over its bins that follows
the gradient of the logistic loss; the trees add up to one look-up table per feature. Then the pairs
of features that explain most of what is left get two-dimensional tables the same way. A score is the
sum of the looked-up values, so many rows are scored by a few vectorised additions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np

ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, RIDGE = 0.1, 5.0
BINS, PAIR_BINS = 48, 12


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edge, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edge, x[:, j], side="right")]
        used = sorted({k for i, j, _ in self.pairs for k in (i, j)})
        coarse = {k: np.searchsorted(self.pair_edges[k], x[:, k], side="right") for k in used}
        for i, j, values in self.pairs:
            out += values[coarse[i], coarse[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Up to ``bins - 1`` edges, midway between different neighbouring quantiles."""
    values = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)))
    return (values[1:] + values[:-1]) / 2


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Value per bin of the best tree of ``depth`` splits in a row over gradient sums g and h."""
    whole = -g.sum() / (h.sum() + RIDGE)
    if depth == 0 or len(g) < 2:
        return np.full(len(g), whole)
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    won = _gain(cg, ch) + _gain(g.sum() - cg, h.sum() - ch) - _gain(g.sum(), h.sum())
    at = int(np.argmax(won)) + 1
    if won[at - 1] <= 1e-9:
        return np.full(len(g), whole)
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut into four quarters of a table of gradient sums."""
    sums = [np.zeros((g.shape[0] + 1, g.shape[1] + 1)) for _ in (g, h)]
    for s, v in zip(sums, (g, h)):
        s[1:, 1:] = v.cumsum(0).cumsum(1)
    cg, ch = sums
    quarters = lambda c: (
        c[1:-1, 1:-1], c[1:-1, -1:] - c[1:-1, 1:-1], c[-1:, 1:-1] - c[1:-1, 1:-1],
        c[-1, -1] - c[1:-1, -1:] - c[-1:, 1:-1] + c[1:-1, 1:-1],
    )
    values = np.zeros(g.shape)
    if min(g.shape) < 2:
        return 0.0, values
    parts = list(zip(quarters(cg), quarters(ch)))
    won = sum(_gain(a, b) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(won)), won.shape)
    for (a, b), rows, cols in zip(
        parts, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)),
        (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None)),
    ):
        values[rows, cols] = -a[i, j] / (b[i, j] + RIDGE)
    return float(won[i, j] - _gain(g.sum(), h.sum())), values


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Learns from a matrix of finite features and labels 0/1; without both labels the score is constant."""
    n, d = x.shape
    mean = (y.sum() + 0.5) / (n + 1)
    model = Gam(float(np.log(mean / (1 - mean))), [np.zeros(0)] * d, [np.zeros(1)] * d, [np.zeros(0)] * d)
    if n == 0 or y.min() == y.max():
        return model
    model.edges = [_cuts(x[:, j], BINS) for j in range(d)]
    model.pair_edges = [_cuts(x[:, j], PAIR_BINS) for j in range(d)]
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(n, model.intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = gradient()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size))
            model.tables[j] += step
            margin += step[fine[j]]

    def crossed(i: int, j: int) -> tuple[float, np.ndarray]:
        shape = (len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)
        cell, (g, h) = coarse[i] * shape[1] + coarse[j], gradient()
        return _cross(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))

    best = sorted(combinations(range(d), 2), key=lambda p: -crossed(*p)[0])[:PAIRS]
    tables = {p: 0.0 for p in best}
    for _ in range(PAIR_ROUNDS):
        for i, j in best:
            step = RATE * crossed(i, j)[1]
            tables[i, j] = tables[i, j] + step
            margin += step[coarse[i], coarse[j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model
