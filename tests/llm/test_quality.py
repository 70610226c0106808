import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tributary.llm import decision_list, rule_ensemble, textstats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    seen, dup = set(), 0
    lines = [x for x in text.split("\n") if WORD.search(x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    if not w:
        return (0, 0, len(re.findall(r"[#*$%&|<>]", text)), 0, 0, 0, 0, 0, 0, 0, 0)
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(lines), len(set(w)),
        len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)), len(re.findall("[0-9]", text)), max(Counter(w).values()),
    )


def texts():
    rng = np.random.default_rng(5)
    some = [" ".join(f"w{x}" for x in rng.integers(0, v, n)) for v, n in ((3, 50), (6, 400), (5000, 300), (2, 9), (9, 4))]
    return [*some, None, "", " \n\t", "é ü x " * 4 + "\nA A\n\nA A\n \nA A", "a b c d e " * 2, "#x $|<>& !? 12 AB", "x " * 20000, "\x1c \x85y\x0bz"]


def test_counts(spark):
    data = [(k, t, 7) for k, t in enumerate(texts())]
    df = spark.createDataFrame(data, "doc_id long, text string, n_words long")
    got = rows(textstats.with_stats(df, keep=["doc_id"]), "doc_id", *textstats.COUNTS)
    assert got == sorted(((k, *brute(t)) for k, t, _ in data), key=repr)


def test_large_vocabulary_is_exact():
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 50_000, 60_000)
    ids[30_000:30_007] = ids[100:107]
    _, dense = np.unique(ids, return_inverse=True)
    assert textstats.repeated(dense, int(dense.max()) + 1) == 14


def test_both_sides_of_a_feature_agree(spark):
    df = textstats.with_stats(spark.createDataFrame([(t,) for t in texts()], "text string"), keep=["text"])
    got = df.select(*textstats.COUNTS, *[textstats.feature(n).alias(f"f_{n}") for n in textstats.RATIOS]).toPandas().to_numpy(float)
    k = len(textstats.COUNTS)
    assert (textstats.features(got[:, :k].astype(np.int64)) == got[:, k:]).all()


def planted(n=3000):
    rng = np.random.default_rng(7)
    x = rng.random((n, len(textstats.RATIOS)))
    bad = ((x[:, 2] > 0.8) & (x[:, 4] > 0.5)) | (x[:, 6] > 0.95)
    return x, bad


def test_decision_list_finds_planted_rules():
    x, bad = planted()
    rules = decision_list.learn(x[:2000], bad[:2000], precision=0.95)
    hit = np.zeros(1000, bool)
    for rule in rules:
        hit |= textstats.holds(x[2000:], rule)
    assert (hit == bad[2000:]).mean() > 0.97
    assert decision_list.learn(x[:50], np.zeros(50, bool)) == []
    assert decision_list.learn(x[:0], np.zeros(0, bool)) == []


def test_ensemble_is_sparse_and_right():
    x, bad = planted()
    start, rules = rule_ensemble.learn(x[:2000], (~bad[:2000]).astype(int))
    total = start + sum(w * textstats.holds(x[2000:], r) for r, w in rules)
    assert ((total > 0) == ~bad[2000:]).mean() > 0.97
    assert len(rules) < len(rule_ensemble.tree_paths(x[:2000], (~bad[:2000]).astype(float)))
    assert rule_ensemble.learn(x[:0], np.zeros(0)) == (0.0, [])
    assert rule_ensemble.learn(x[:9], np.ones(9))[1] == []


def test_compiled_columns_equal_numpy(spark):
    df = textstats.with_stats(spark.createDataFrame([(t,) for t in texts()], "text string"), keep=["text"])
    model = (0.3, [(((0, False, 9.5), (9, True, 0.4)), -1.5), (((2, True, 0.1),), 0.7)])
    counts = df.select(*textstats.COUNTS).toPandas().to_numpy(np.int64)
    x = textstats.features(counts)
    expected = rule_ensemble.sigmoid(0.3 + sum(w * textstats.holds(x, r) for r, w in model[1]))
    got = df.select(rule_ensemble.score(model)).toPandas().to_numpy()[:, 0]
    assert np.allclose(got, expected)
    rules = [model[1][0][0], model[1][1][0]]
    first = [next((textstats.as_text(r) for r in rules if textstats.holds(x[k : k + 1], r)[0]), None) for k in range(len(x))]
    assert [r[0] for r in df.select(decision_list.first_rule(rules)).collect()] == first


def test_learning_from_tables(spark):
    docs = [(k, ("*** $$$ &&& " * 20 if k % 3 == 0 else " ".join(f"w{(k * j) % 97}" for j in range(60)))) for k in range(300)]
    docs += [(None, "x"), (5, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("clash")).withColumn("quality", F.lit(3))
    y = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(300)] + [(None, 1), (7, None)], "doc_id long, quality long")
    rules = decision_list.fit(d, y)
    judged = {r["doc_id"]: r for r in decision_list.judge(d.where("n_words = 'clash'"), rules).where("doc_id != 5").collect()}
    assert all(judged[k]["kept"] == (k % 3 != 0) for k in judged if k % 97)
    model = rule_ensemble.fit(d, y)
    scored = {r["doc_id"]: r["score"] for r in rule_ensemble.classify(d, model, keep=["doc_id"]).where("doc_id != 5").collect()}
    assert all((scored[k] >= 0.3) == (k % 3 != 0) for k in scored if k % 97)
    nothing = y.limit(0)
    assert decision_list.fit(d, nothing) == [] and rule_ensemble.fit(d, nothing) == (0.0, [])
    assert rows(decision_list.judge(d.limit(0), rules)) == []
    assert decision_list.judge(d.where("doc_id is null"), []).first()["base_failed"]
