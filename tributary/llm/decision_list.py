"""Quality rules as a learned decision list.

Sequential covering over labelled statistics: a rule grows by the threshold condition with the best information gain until it
covers no good row of the growing part, then loses conditions from its end while that raises its worth on the pruning part. It is
kept if at least `precision` of what it covers there is bad. What a rule covers is taken out and the next one is
sought, until `PATIENCE` in a row were not good enough or no bad row is left. The list is emitted as one ordered Spark conditional expression.

The rules are learned on the driver from at most `rows` labelled rows (a bounded sample, see textstats.sample) and applied to all
documents. Without labels, or with one kind only, the list is empty and rejects nothing. Null and empty texts have counts 0 and fail the base
rule, as do texts of fewer than ten words. Repeated rows stay repeated; null labels are ignored. Equal
gains fall to the first statistic and threshold tried. Very long texts are measured whole; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.textstats import Condition, as_column, as_text, cuts, holds, sample, with_stats

#: Labelled rows to learn from; the share of bad rows a rule must have on the pruning part, and how many it must cover there.
ROWS, PRECISION, SUPPORT = 20_000, 0.98, 5
#: Failed rules in a row that end the learning.
PATIENCE = 5

Rule = tuple[Condition, ...]


def grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: list[Condition] = []
    live = np.ones(len(x), bool)
    while (~bad[live]).any():
        here, hit = x[live], bad[live]
        p0, n0 = hit.sum(), (~hit).sum()
        base = np.log2(p0 / (p0 + n0))
        best, gain = None, 1e-9
        for f in range(x.shape[1]):
            at = cuts(here[:, f])
            place = np.searchsorted(at, here[:, f], side="left")  # values up to at[k] come before place k + 1
            p = np.cumsum(np.bincount(place[hit], minlength=len(at) + 1))[:-1]
            n = np.cumsum(np.bincount(place[~hit], minlength=len(at) + 1))[:-1]
            for below, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                worth = pp * (np.log2(np.maximum(pp, 1e-9) / np.maximum(pp + nn, 1)) - base)
                if len(worth) and worth.max() > gain:
                    gain, best = worth.max(), (f, below, float(at[worth.argmax()]))
        if best is None:
            break
        rule.append(best)
        live &= holds(x, (best,))
    return tuple(rule)


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    def worth(some: Rule) -> float:
        hit = holds(x, some)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / max(p + n, 1)

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn(x: np.ndarray, bad: np.ndarray, precision: float = PRECISION, support: int = SUPPORT) -> list[Rule]:
    """Rules for bad rows, in order. Every third row is kept for pruning."""
    bad = bad.astype(bool)
    third = np.arange(len(x)) % 3 == 2
    left, rules, failed = np.ones(len(x), bool), [], 0
    while failed < PATIENCE:
        growing, pruning = left & ~third, left & third
        if not bad[growing].any() or bad[growing].all():
            break
        rule = prune(grow(x[growing], bad[growing]), x[pruning], bad[pruning])
        hit = holds(x, rule)
        p, n = (hit & pruning & bad).sum(), (hit & pruning & ~bad).sum()
        if not rule:
            break
        if p >= max(support, precision * (p + n)):
            rules.append(rule)
            failed = 0
            left &= ~hit
        else:
            failed += 1
            left &= ~(hit & bad & ~third)  # those are not grown from again
    return rules


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> list[Rule]:
    """The list learned from documents labelled 0 (bad) or 1."""
    x, y = sample(docs, labels, label, rows, id_col=id_col, text_col=text_col)
    return learn(x, y == 0)


def first_rule(rules: list[Rule]) -> Column:
    """The first rule that holds, as text; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(as_column(rule), F.lit(as_text(rule))).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with their counts, base_failed, rule (that rejects, or null) and kept."""
    judged = with_stats(docs, text_col, keep).withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
