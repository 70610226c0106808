"""Quality classifier as a sparse ensemble of rules.

Small boosted trees are grown on labelled statistics; each path from a root to a node is a conjunctive rule. A logistic
regression with an absolute-value penalty then weighs the rules, and those with weight 0 are gone. What is left is a sum of Spark
conditional expressions over the statistics' columns: scoring needs no model object and no Python beyond the statistics.

Learned on the driver from at most `rows` labelled rows outside the held-out fold (a bounded sample, see textstats.sample), applied to all
documents. Inputs are statistics of the text alone. Null text is scored as the empty text. Without labels every score is 0.5; with
one kind only, the score is close to that label. Repeated rows stay repeated. Equal gains fall to the first statistic and threshold tried. Very long
texts are measured whole; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.textstats import Condition, as_column, cuts, holds, sample, with_stats

#: Labelled rows to learn from, trees, their depth and step, fewest rows of a node, weight of the penalty.
ROWS, TREES, DEPTH, STEP, LEAST, PENALTY = 20_000, 40, 3, 0.3, 20, 5e-4

Rule = tuple[Condition, ...]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def tree_paths(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """The paths to all nodes of boosted trees, each once, in the order they were grown."""
    edges = [cuts(x[:, f]) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]
    margin, paths = np.zeros(len(x)), {}
    for _ in range(trees):
        p = sigmoid(margin)
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        front: list[tuple[Rule, np.ndarray]] = [((), np.arange(len(x)))]
        for level in range(depth + 1):
            following = []
            for path, rows in front:
                split = best_split(rows, bins, edges, gradient, weight) if level < depth else None
                if split is None:
                    margin[rows] += STEP * gradient[rows].sum() / (weight[rows].sum() + 1)
                    continue
                f, k = split
                low = bins[f][rows] <= k
                for below, part in ((True, rows[low]), (False, rows[~low])):
                    longer = (*path, (f, below, float(edges[f][k])))
                    paths[tuple(sorted(longer))] = None
                    following.append((longer, part))
            front = following
    return list(paths)


def best_split(rows, bins, edges, gradient, weight) -> tuple[int, int] | None:
    g, h = gradient[rows], weight[rows]
    total = g.sum() ** 2 / (h.sum() + 1)
    best, worth = None, 1e-3
    for f, edge in enumerate(edges):
        if not len(edge):
            continue
        at = bins[f][rows]
        count = np.cumsum(np.bincount(at, minlength=len(edge) + 1))[:-1]
        left_g = np.cumsum(np.bincount(at, g, len(edge) + 1))[:-1]
        left_h = np.cumsum(np.bincount(at, h, len(edge) + 1))[:-1]
        gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - total
        gain[(count < LEAST) | (len(rows) - count < LEAST)] = -1
        if gain.max() > worth:
            worth, best = gain.max(), (f, int(gain.argmax()))
    return best


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 600) -> tuple[float, np.ndarray]:
    """(intercept, weights) of the penalised logistic regression, by accelerated proximal steps."""
    z = np.hstack([np.ones((len(z), 1)), z])
    w = np.zeros(z.shape[1])
    w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ahead, t = w.copy(), 1.0
    # the largest singular value by power iteration bounds the curvature
    v = np.ones(z.shape[1])
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    rate = 4 * len(z) / (np.linalg.norm(z @ v) ** 2 * 1.05)
    for _ in range(steps):
        new = ahead - rate * (z.T @ (sigmoid(z @ ahead) - y)) / len(z)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


def learn(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, rules with their weights)."""
    if not len(x):
        return 0.0, []
    if y.min() == y.max():
        return float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), []
    rules = tree_paths(x, y.astype(float))
    if not rules:
        return float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), []
    start, weights = lasso(np.stack([holds(x, r) for r in rules], axis=1).astype(float), y.astype(float))
    return start, [(r, float(w)) for r, w in zip(rules, weights) if w != 0]


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[float, list[tuple[Rule, float]]]:
    return learn(*sample(docs, labels, label, rows, id_col=id_col, text_col=text_col))


def score(model: tuple[float, list[tuple[Rule, float]]]) -> Column:
    """The compiled model: a column between 0 and 1 over the statistics' columns."""
    start, rules = model
    total = F.lit(start)
    for rule, weight in rules:
        total = total + F.when(as_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def classify(docs: DataFrame, model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with their counts and score (near 1: label 1 is likely)."""
    return with_stats(docs, text_col, keep).withColumn("score", score(model))
