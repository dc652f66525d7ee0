"""Gradient-boosted trees with monotonic constraints, as numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 64
_RIDGE, _LEAST_ROWS = 1.0, 20


@dataclass
class Forest:
    """Nodes of all trees: `feature` below zero marks a leaf, `low`/`high` are the children."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of the positive class for each row, all trees at once, level by level."""
        node = np.tile(self.roots, (len(rows), 1))
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            feature = self.feature[node]
            goes_low = rows[at, np.maximum(feature, 0)] <= self.threshold[node]
            node = np.where(feature < 0, node, np.where(goes_low, self.low[node], self.high[node]))
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit(
    rows: np.ndarray, labels: np.ndarray, signs: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
) -> Forest:
    """Logistic boosting; a feature with sign +1 (-1) never lowers (raises) the score as it grows.

    A split on such a feature must order its children's values that way, and both sides then keep to
    their side of the mean of the two, so the order holds for the whole subtree.
    """
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # feature, threshold, low, high, value
    roots, margin = [], np.full(len(rows), base)
    for _ in range(trees):
        chance = 1.0 / (1.0 + np.exp(-margin))
        slope, bend = labels - chance, chance * (1 - chance)
        roots.append(len(nodes))
        nodes.append([-1, 0.0, 0, 0, 0.0])
        waiting = [(roots[-1], np.arange(len(rows)), 0, -np.inf, np.inf)]
        while waiting:
            node, own, level, least, most = waiting.pop()
            value = _value(slope[own].sum(), bend[own].sum(), least, most)
            found = _best_split(binned, own, slope, bend, cuts, signs, least, most) if level < depth else None
            if found is None:
                nodes[node][4] = rate * value
                margin[own] += rate * value
                continue
            feature, cut, low_value, high_value = found
            goes_low = binned[own, feature] <= cut
            middle = (low_value + high_value) / 2
            low_bounds, high_bounds = (least, most), (least, most)
            if signs[feature] > 0:
                low_bounds, high_bounds = (least, middle), (middle, most)
            elif signs[feature] < 0:
                low_bounds, high_bounds = (middle, most), (least, middle)
            nodes[node][:4] = [feature, float(cuts[feature][cut]), len(nodes), len(nodes) + 1]
            nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
            waiting.append((len(nodes) - 2, own[goes_low], level + 1, *low_bounds))
            waiting.append((len(nodes) - 1, own[~goes_low], level + 1, *high_bounds))
    table = np.array(nodes)
    whole = [table[:, i].astype(np.int64) for i in (0, 2, 3)]
    return Forest(np.array(roots), whole[0], table[:, 1], whole[1], whole[2], table[:, 4], base, depth)


def _value(slope, bend, least, most):
    return np.clip(slope / (bend + _RIDGE), least, most)


def _best_split(binned, own, slope, bend, cuts, signs, least, most):
    """`(feature, cut, low value, high value)` of the split that gains most, or None."""
    best, found = 1e-6, None
    s_all, b_all, n_all = slope[own].sum(), bend[own].sum(), len(own)
    v_all = _value(s_all, b_all, least, most)
    before = s_all * v_all - 0.5 * (b_all + _RIDGE) * v_all**2
    for feature, edges in enumerate(cuts):
        if not len(edges):
            continue
        bins = binned[own, feature]
        s, b, n = (
            np.cumsum(np.bincount(bins, w, len(edges) + 1))[:-1] for w in (slope[own], bend[own], np.ones(n_all))
        )
        low, high = _value(s, b, least, most), _value(s_all - s, b_all - b, least, most)
        gain = s * low - 0.5 * (b + _RIDGE) * low**2 - before
        gain += (s_all - s) * high - 0.5 * (b_all - b + _RIDGE) * high**2
        allowed = (n >= _LEAST_ROWS) & (n_all - n >= _LEAST_ROWS) & (signs[feature] * (high - low) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        cut = int(np.argmax(gain))
        if gain[cut] > best:
            best, found = gain[cut], (feature, cut, low[cut], high[cut])
    return found
