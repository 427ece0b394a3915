"""Gradient-boosted trees on a small table of counted feature vectors.

The vectors are integers with few values each, so a corpus of any size
aggregates to a bounded number of cells (vector, positives, negatives). Fitting
is Newton boosting of the logistic loss on those cells; a fitted model becomes
one Spark expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

Cell = tuple[tuple[int, ...], int, int]


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    at_most: int
    low: Leaf | Split
    high: Leaf | Split


def _value(node, x) -> float:
    while isinstance(node, Split):
        node = node.low if x[node.feature] <= node.at_most else node.high
    return node.value


def _grow(cells, depth: int, ridge: float, least: float):
    """Best tree for cells of (vector, gradient sum, curvature sum)."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = Leaf(-g / (h + ridge))
    if depth == 0 or len(cells) < 2:
        return leaf
    score = lambda a, b: a * a / (b + ridge)
    best, gain = None, 1e-9
    for f in range(len(cells[0][0])):
        sums: dict[int, list[float]] = {}
        for x, cg, ch in cells:
            s = sums.setdefault(x[f], [0.0, 0.0])
            s[0] += cg
            s[1] += ch
        lg = lh = 0.0
        for v in sorted(sums)[:-1]:
            lg, lh = lg + sums[v][0], lh + sums[v][1]
            if min(lh, h - lh) >= least and (now := score(lg, lh) + score(g - lg, h - lh) - score(g, h)) > gain:
                best, gain = (f, v), now
    if best is None:
        return leaf
    f, v = best
    low, high = [c for c in cells if c[0][f] <= v], [c for c in cells if c[0][f] > v]
    return Split(f, v, _grow(low, depth - 1, ridge, least), _grow(high, depth - 1, ridge, least))


@dataclass
class BoostedTrees:
    """``margin`` is the log odds; ``column`` the same as an expression."""
    base: float = 0.0
    rate: float = 0.3
    trees: list = field(default_factory=list)

    def margin(self, x) -> float:
        return self.base + self.rate * sum(_value(t, x) for t in self.trees)

    def column(self, features: list[Column]) -> Column:
        def of(node) -> Column:
            if isinstance(node, Leaf):
                return F.lit(node.value)
            return F.when(features[node.feature] <= node.at_most, of(node.low)).otherwise(of(node.high))
        return F.lit(self.base) + F.lit(self.rate) * sum((of(t) for t in self.trees), F.lit(0.0))


def fit(cells: list[Cell], *, rounds: int = 20, depth: int = 3, rate: float = 0.3, ridge: float = 1.0,
        least: float = 0.1) -> BoostedTrees:
    """Fits positives against negatives (both smoothed by half a count for the
    starting odds). No cells give a model that says 0 everywhere."""
    pos, neg = sum(c[1] for c in cells), sum(c[2] for c in cells)
    model = BoostedTrees(math.log((pos + 0.5) / (neg + 0.5)), rate)
    cells = sorted(cells)
    margins = [model.base] * len(cells)
    for _ in range(rounds if cells else 0):
        bent = []
        for (x, p, n), m in zip(cells, margins):
            q = 1 / (1 + math.exp(-m))
            bent.append((x, (p + n) * q - p, (p + n) * q * (1 - q)))
        tree = _grow(bent, depth, ridge, least)
        model.trees.append(tree)
        margins = [m + rate * _value(tree, x) for (x, _, _), m in zip(cells, margins)]
    return model


def calibrate(scored: list[tuple[float, int, int]], precision: float) -> float:
    """The smallest margin from which on the held-out positives make up at
    least ``precision`` by isotonic regression; infinity if there is none."""
    blocks: list[list[float]] = []
    by_margin: dict[float, list[int]] = {}
    for m, p, n in scored:
        c = by_margin.setdefault(round(m, 9), [0, 0])
        c[0] += p
        c[1] += n
    for m in sorted(by_margin):
        p, n = by_margin[m]
        blocks.append([m, p, n])
        while len(blocks) > 1 and blocks[-2][1] * (blocks[-1][1] + blocks[-1][2]) >= blocks[-1][1] * (blocks[-2][1] + blocks[-2][2]):
            _, p, n = blocks.pop()
            blocks[-1][1] += p
            blocks[-1][2] += n
    return next((m for m, p, n in blocks if p > 0 and p >= precision * (p + n)), math.inf)
