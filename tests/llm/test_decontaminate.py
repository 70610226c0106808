import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    """(id, words, hit places, longest match that holds a window, items) of each document."""
    out = []
    for i, text in docs:
        w, hit, longest, names = words(text), set(), 0, set()
        for name, item in items:
            v = words(item)
            size = min(window, len(v))
            for a in range(len(v) - size + 1 if v else 0):
                for b in range(len(w) - size + 1):
                    if w[b : b + size] == v[a : a + size]:
                        hit |= set(range(b, b + size))
                        if name is not None:
                            names.add(name)
        for b in range(len(w)):
            reach = max((common(w[b:], words(item)[a:]) for _, item in items for a in range(len(words(item)))), default=0)
            starts = any(w[b : b + min(window, len(v))] == v[a : a + min(window, len(v))] for _, item in items if (v := words(item)) for a in range(len(v) - min(window, len(v)) + 1))
            longest = max(longest, reach if starts else 0)
        out.append((i, len(w), sorted(hit), longest, sorted(names)))
    return out


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    out = []
    for r in decontaminate.find(d, b, **options).collect():
        hit = [p for s in r["spans"] for p in range(s["first"], s["last"] + 1)]
        out.append((r["id"], r["n_words"], hit, r["longest"], r["items"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,block", [(3, 10**6), (3, 20), (10, 10**6), (1, 10**6)])
def test_equal_to_brute_force(spark, window, block):
    rng = np.random.default_rng(window)
    text = lambda n, v: " ".join(f"W{x}" for x in rng.integers(0, v, n))
    items = [(f"i{k}", text(int(rng.integers(1, 30)), 6)) for k in range(8)] + [("dup", "a b c d"), ("dup2", "a b c d"), ("none", " .,"), ("null", None), (None, "q r s t")]
    docs = [(k, text(int(rng.integers(0, 60)), 7)) for k in range(25)]
    docs += [(90, None), (91, ""), (92, "x A, b.C d! " * 40), (93, items[0][1] + " zz " + items[0][1]), (93, "a b c d"), (94, "q R s t é")]
    assert found(spark, docs, items, window=window, block_words=block) == sorted(brute(docs, items, window), key=repr)


def test_removes_affected_documents_and_keeps_columns(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    data = [(1, f"so {passage} it goes", "p"), (2, "clean text", "q"), (2, "clean text", "q"), (3, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, spans string").withColumn("id", F.lit(5))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.remove(docs, items)
    assert kept.columns == docs.columns
    assert rows(kept) == sorted([(2, "clean text", "q", 5)] * 2 + [(3, None, None, 5)], key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a")], "item_id string, text string")
    assert found(spark, [(1, "a b")], []) == [(1, 2, [], 0, [])]
    assert rows(decontaminate.find(docs.limit(0), items)) == []


def test_repeated_items_do_not_fill_a_block(spark):
    data = [("a", "one two three four")] * 500 + [(f"i{k}", f"item{k} has five words here") for k in range(300)] + [(None, None)] * 50
    df = spark.createDataFrame(data, "item_id string, text string")
    blocks = list(decontaminate.blocks_of(df, "item_id", "text", 400))
    assert [last for _, last in blocks] == [False] * (len(blocks) - 1) + [True] and len(blocks) > 5
    assert max(sum(len(t.split()) for _, t in items) for items, _ in blocks) <= 400
    held = [(i, t.decode()) for items, _ in blocks for i, t in items]
    assert sorted(held, key=repr) == sorted({(i, t or "") for i, t in data}, key=repr)


def test_blocks_are_searched_one_after_another(spark):
    """Three blocks and more give the same as brute force, and no stage holds two of them."""
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 40, n))
    items = [(f"i{k}", text(25)) for k in range(12)]
    docs = [(k, text(30) + " " + items[k % 12][1][: 10 * k]) for k in range(30)]
    searches = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), block_words=90, window=5)
    assert searches._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found(spark, docs, items, block_words=90, window=5) == sorted(brute(docs, items, 5), key=repr)


def test_a_full_block_is_small():
    """A block of many items with a shared instruction: memory, and time for a text full of that instruction."""
    import time
    import tracemalloc

    rng = np.random.default_rng(6)
    prompt = " ".join(f"prompt{k}" for k in range(30))
    items = [(f"i{k}", (prompt + " " + " ".join(f"v{x}" for x in rng.integers(0, 50_000, 30))).encode()) for k in range(8_000)]
    tracemalloc.start()
    held = decontaminate.Items(items, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20 and len(held.text) <= decontaminate.BLOCK_WORDS
    ids = np.array([held.vocabulary[w] for w in prompt.encode().split()] * 400 + [0], np.int64)
    start = time.process_time()
    place, which = held.occurrences(ids)
    reach = held.reach(ids, place)
    assert time.process_time() - start < 2 and len(place) == 400 * 21 and reach.max() == 30
    assert sorted(held.names(int(which[0]))) == sorted(i for i, _ in items)


def test_the_longest_match_among_equal_windows():
    items = [(f"i{k}", ("a b c d " + " ".join(f"x{j}" for j in range(k))).encode()) for k in range(40)]
    held = decontaminate.Items(items, 4)
    words_ = "a b c d x0 x1 x2 x3 x4 zz a b c d x1 a b c d".split()
    ids = np.array([held.vocabulary.get(w.encode(), 0) for w in words_] + [0], np.int64)
    assert held.reach(ids, np.array([0, 10, 15])).tolist() == [9, 4, 4]
