import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from conftest import rows
from tributary.llm import interpolation as lm

FOLD = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10


def tokens(text):
    return (text or "").encode().lower().split() + [b" "]


def brute(data):
    """Scores with plain counters; the weights come from events that are not pooled on a grid."""
    count, pairs, kept, kept_pairs, held = Counter(), Counter(), Counter(), Counter(), []
    for i, text in data:
        t = tokens(text)
        if FOLD(i):
            both = list(zip([b" ", *t[:-1]], t))
            count.update(t)
            pairs.update(both)
            if FOLD(i) == lm.DELETED:
                held += both
            else:
                kept.update(t)
                kept_pairs.update(both)
    n, v, r = sum(count.values()), len(count), sum(kept.values())
    b = lambda c: 1 + int(math.floor(math.log2(c))) if c else 0
    events = np.array([(b(kept[x]), kept_pairs[x, y] / max(kept[x], 1), kept[y] / max(r, 1)) for x, y in held]).reshape(-1, 3)
    weights = em(events, v)
    out = []
    for i, text in data:
        t = tokens(text)
        score = 0.0
        for x, y in zip([b" ", *t[:-1]], t):
            w = weights[b(count[x])]
            score += math.log10(w[0] * pairs[x, y] / max(count[x], 1) + w[1] * count[y] / n + w[2] / (v + 1)) if n else 0.0
        base = sum(math.log10((count[y] + 0.1) / (n + 0.1 * (v + 1))) for y in t)
        out.append((i, FOLD(i) == 0, len(t), sum(count[y] > 0 for y in t), n, base, score))
    return out


def em(events, v):
    if not len(events):
        weights = np.tile(lm.DEFAULT, (65, 1))
    else:
        at, p = events[:, 0].astype(int), np.hstack([events[:, 1:], np.full((len(events), 1), 1 / (v + 1))])
        pooled = np.array(lm.DEFAULT)
        for _ in range(lm.EM_STEPS):
            post = p * pooled
            pooled = (post / post.sum(axis=1, keepdims=True)).mean(axis=0)
        weights = np.tile(pooled, (65, 1))
        for _ in range(lm.EM_STEPS):
            post = p * weights[at]
            post /= post.sum(axis=1, keepdims=True)
            for k in range(65):
                mass = post[at == k].sum(axis=0) + lm.PRIOR * pooled
                weights[k] = mass / mass.sum()
    weights[0, 0] = 0
    weights[:, 2] = np.maximum(weights[:, 2], lm.LEAST_SHARE)
    return weights / weights.sum(axis=1, keepdims=True)


def some_documents():
    rng = np.random.default_rng(8)
    data = []
    for k in range(120):
        at, words = 0, []
        for _ in range(int(rng.integers(0, 60))):
            at = (at * 3 + int(rng.integers(0, 3))) % 40
            words.append(f"W{at}" if rng.random() < 0.9 else f"rare{rng.integers(0, 500)}")
        data.append((k, " ".join(words)))
    return data + [(500, None), (501, ""), (None, "W1 w2 unknown"), (7, data[7][1]), (502, "é Ü\x0bw1\x1cx " * 40)]


@pytest.mark.parametrize("size,per_bucket", [(lm.SLICE, lm.BUCKET), (100, 50)])
def test_equal_to_plain_counting(spark, size, per_bucket):
    data = some_documents()
    df = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, score string").repartition(3)
    got = rows(lm.scores(df, size=size, per_bucket=per_bucket))
    expected = sorted(brute(data), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    assert np.allclose([r[6] for r in got], [r[6] for r in expected], rtol=0.01)  # the grid moves the weights a little


def test_better_than_the_base_on_held_out_documents(spark):
    df = spark.createDataFrame(some_documents(), "doc_id long, text string")
    held = [r for r in lm.scores(df).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_sum_to_one():
    model = lm.Model(lm.learn(np.array([[1, -16, -32, 5], [1, lm.NEVER, lm.NEVER, 2], [0, lm.NEVER, -20, 4]]), 4), 20, 4)
    word = np.array([10, 5, 4, 1, 0])
    pair = np.array([2, 1, 0, 0, 0])
    assert math.isclose(model.probability(pair, np.full(5, 3), word).sum(), 1)
    assert math.isclose(model.probability(np.zeros(5), np.zeros(5, int), word).sum(), 1)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rows(lm.scores(df)) == []
    held = next(i for i in range(100) if FOLD(i) == 0)
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    assert rows(lm.scores(df)) == [(held, True, 3, 0, 0, 0.0, 0.0)]


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=20), max_size=4))
def test_arrays_survive(arrays):
    given_ = [np.array(a, np.uint64) for a in arrays]
    back = lm.unsqueeze(lm.squeeze(*given_))
    assert [b.tolist() for b in back] == arrays
    for a in given_:
        a.sort()
        assert np.cumsum(lm.steps(a), dtype=np.uint64).tolist() == a.tolist()
