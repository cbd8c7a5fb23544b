"""Quality rules: gradient-boosted trees over statistics of whole texts, and fixed base rules.

The trees are grown on histograms of the statistics with the logistic loss. A feature may be
declared monotone: a split that would order its two leaf values the wrong way is not taken, and the
middle of the two values bounds all leaves below, so the constraint holds for the whole tree. All
trees are flattened into one set of arrays (feature, threshold, left, right, value); scoring moves
all rows of a batch down one level at a time.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywork.llm.stats import STATISTICS, labelled_sample, matrix
from tallywork.llm.texts import arrow_rows

FIT_ROWS = 8000
KEEP_FROM = 0.3
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
# -1: a larger value never makes a text better; +1: never worse
MONOTONE = {"symbols": -1, "marks": -1, "bars": -1, "repeat_words": -1, "same_as_last": -1}


@dataclass(frozen=True)
class Trees:
    """Flattened trees; a leaf points to itself. ``roots`` has the first node of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values for each row of ``x``."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """Likelihood of label 1 for each row, from 0 to 1."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


class _Grower:
    """Grows trees on binned statistics."""

    def __init__(self, x: np.ndarray, signs: np.ndarray, depth: int, bins: int, ridge: float):
        self.signs, self.depth, self.ridge, self.least = signs, depth, ridge, 20
        inner = np.linspace(0, 1, bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, inner)) for column in x.T]
        self.width = bins + 1
        self.binned = np.stack(
            [np.searchsorted(cut, column) for cut, column in zip(self.cuts, x.T, strict=True)], 1
        )
        self.nodes: list[list] = []  # feature, threshold, left, right, value

    def _leaf(self, g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + self.ridge), low, high))

    def _best(self, rows, gradient, hessian, low, high):
        """The split with the largest gain: gain, feature, bin, left and right value."""
        n_features, width = self.binned.shape[1], self.width
        place = (self.binned[rows] + np.arange(n_features) * width).ravel()

        def sums(values):
            flat = np.bincount(place, np.repeat(values, n_features), n_features * width)
            return flat.reshape(n_features, width).cumsum(axis=1)

        g, h, n = sums(gradient[rows]), sums(hessian[rows]), sums(np.ones(len(rows)))
        right_g, right_h, right_n = g[:, -1:] - g, h[:, -1:] - h, n[:, -1:] - n
        left_value = np.clip(-g / (h + self.ridge), low, high)
        right_value = np.clip(-right_g / (right_h + self.ridge), low, high)

        def won(g, h, value):  # by which a leaf with this value lowers the loss
            return -(g * value + 0.5 * (h + self.ridge) * value**2)

        whole = self._leaf(g[0, -1], h[0, -1], low, high)
        gain = won(g, h, left_value) + won(right_g, right_h, right_value)
        gain -= won(g[:, -1:], h[:, -1:], whole)
        wrong = self.signs[:, None] * (right_value - left_value) < 0
        gain[wrong | (n < self.least) | (right_n < self.least)] = -np.inf
        feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
        return gain[feature, cut], feature, cut, left_value[feature, cut], right_value[feature, cut]

    def grow(self, rows, gradient, hessian, depth=0, low=-np.inf, high=np.inf) -> int:
        """Add the nodes of one tree; returns the place of its root."""
        me = len(self.nodes)
        value = self._leaf(gradient[rows].sum(), hessian[rows].sum(), low, high)
        self.nodes.append([0, np.inf, me, me, value])
        if depth == self.depth or len(rows) < 2 * self.least:
            return me
        gain, feature, cut, a, b = self._best(rows, gradient, hessian, low, high)
        if not gain > 1e-6:
            return me
        goes_left = self.binned[rows, feature] <= cut
        middle, sign = (a + b) / 2, self.signs[feature]
        left_bounds = (low, middle) if sign > 0 else (middle, high) if sign < 0 else (low, high)
        right_bounds = (middle, high) if sign > 0 else (low, middle) if sign < 0 else (low, high)
        left = self.grow(rows[goes_left], gradient, hessian, depth + 1, *left_bounds)
        right = self.grow(rows[~goes_left], gradient, hessian, depth + 1, *right_bounds)
        self.nodes[me] = [feature, self.cuts[feature][cut], left, right, value]
        return me


def fit(
    x: np.ndarray,
    y: np.ndarray,
    *,
    monotone: dict[int, int],
    trees: int = 60,
    depth: int = 3,
    bins: int = 32,
    rate: float = 0.2,
    ridge: float = 1.0,
) -> Trees:
    """Boosted trees for labels ``y``; ``monotone`` maps columns of ``x`` to -1 or +1.

    Without rows of both labels there are no trees and every score is 1.
    """
    none = np.empty(0, dtype=int)
    if len(set(y.tolist())) < 2:
        return Trees(none, np.empty(0), none, none, np.empty(0), none, depth, 40.0)
    signs = np.array([monotone.get(i, 0) for i in range(x.shape[1])])
    grower = _Grower(x, signs, depth, bins, ridge)
    base = float(np.log(y.mean() / (1 - y.mean())))
    rows, margin, roots = np.arange(len(y)), np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        first = len(grower.nodes)
        roots.append(grower.grow(rows, p - y, p * (1 - p)))
        for node in grower.nodes[first:]:
            node[4] *= rate
        margin = margin + _flat(grower.nodes, [roots[-1]], depth, 0.0).raw(x)
    return _flat(grower.nodes, roots, depth, base)


def _flat(nodes: list[list], roots: list[int], depth: int, base: float) -> "Trees":
    feature, threshold, left, right, value = zip(*nodes, strict=True)
    return Trees(
        np.array(feature, dtype=int),
        np.array(threshold),
        np.array(left),
        np.array(right),
        np.array(value),
        np.array(roots),
        depth,
        base,
    )


def fit_rules(docs: DataFrame, labels: DataFrame, *, rows: int = FIT_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents that are not held out; see ``labelled_sample``."""
    x, y = labelled_sample(docs, labels, "quality", rows)
    monotone = {STATISTICS.index(name): sign for name, sign in MONOTONE.items()}
    return fit(x, y, monotone=monotone)


def apply_rules(
    docs: DataFrame,
    model: Trees,
    *,
    keep: list[str],
    text: str = "text",
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """Counts and verdict of every whole text, in one pass without a shuffle.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``rule_score`` and ``kept`` to the columns ``keep``. The base rules reject a text
    of under 10 words or with over 20 percent of its words in repeated 5-word windows; all others
    stay if the trees give them ``keep_from`` or more. NULL and empty texts have no words and fail.
    Rows are judged one by one, repeated rows alike; other columns are not read.
    """

    def make(texts: list[bytes]) -> list[pa.Array]:
        counts, values = matrix(texts)
        score = model.score(values)
        n = np.array([c.n_words for c in counts], dtype=np.int64)
        repeated = np.array([c.n_repeat_words for c in counts], dtype=np.int64)
        failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)
        return [
            pa.array(n),
            pa.array([c.word_chars for c in counts], pa.int64()),
            pa.array([c.n_symbols for c in counts], pa.int64()),
            pa.array([c.n_dup_lines for c in counts], pa.int64()),
            pa.array(repeated),
            pa.array(failed),
            pa.array(score),
            pa.array(~failed & (score >= keep_from)),
        ]

    added = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, rule_score double, kept boolean"
    )
    return arrow_rows(docs, keep, text, make, added)
