"""Ranked search: the hybrid equals scoring every document, for any shards, windows and blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tributary.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = []
    for q, terms in asked.items():
        scores = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            scores.append((-s, i is None, i if i is not None else 0, i))
        best = sorted(x for x in scores if x[0] < 0)[:k]
        out += [(q, r, x[3], -x[0]) for r, x in enumerate(best, 1)]
    return sorted(out, key=repr)


def some(seed, n, words):
    draw = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(words)] + ["École", "日本", "a", "A1"]
    weights = [1 / (i + 1) ** 0.9 for i in range(len(vocabulary))]
    rows = [(3 * i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 5, 40, 200])))) for i in range(n)]
    rows += [(7, "t0 t1 t2"), (7, "t0 t1 t2"), (8, None), (9, ""), (10, " .,-\x7f"), (None, "t0 t1 rare"), (None, "t5 t6"), (5000, "t3 t0 " * 4000)]
    items = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 3, 30])))) for i in range(25)]
    items += [(100, None), (101, "nowhere"), (3, "t0 rare"), (None, "rare t1, T0"), (102, "T0 t0 t0"), (103, " ".join(vocabulary))]
    return rows, items


def found(spark, docs, items, k=10, shard_terms=lexical.SHARD, **options):
    index = lexical.build(spark.createDataFrame(docs, DOCS), shard_terms=shard_terms)
    got = lexical.search(index, spark.createDataFrame(items, ITEMS), k=k, **options)
    assert got.columns == ["query", "rank", "id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("shard_terms, pairs, long_from", [(1 << 21, 200_000, 256), (3000, 60, 4), (1 << 21, 200_000, 4)])
def test_equals_scoring_all(spark, monkeypatch, shard_terms, pairs, long_from):
    monkeypatch.setattr(lexical, "LONG", long_from)
    docs, items = some(1, 600, 60)
    frame = spark.createDataFrame(docs, DOCS).coalesce(2)
    index = lexical.build(frame, shard_terms=shard_terms)
    got = lexical.search(index, spark.createDataFrame(items, ITEMS), block_pairs=pairs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items)


def block_of(docs, items, monkeypatch, long_from):
    """A shard and a block of queries without Spark, to look inside."""
    monkeypatch.setattr(lexical, "LONG", long_from)
    monkeypatch.setattr(lexical, "LONG_SHARE", 0)
    kind = "n_docs long, n_terms long, ids array<long>, terms binary, dfs binary, lengths binary, postings binary"
    schema = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())), *[(n, pa.binary()) for n in kind.replace(" binary", "").split(", ")[3:]]])
    batch = pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in docs], pa.int64()), "t": pa.array([t.encode() for _, t in docs])})
    row = next(iter(lexical.Shards(schema, 1 << 30)([batch])))
    held = [Counter(terms_of(t)) for _, t in docs]
    pairs = [(q, t.encode()) for q, text in items for t in dict.fromkeys(terms_of(text))]
    block = lexical.Queries(pairs, pa.int64())
    df = {block.number[t.encode()]: sum(t in c for c in held) for t in {t for c in held for t in c} if t.encode() in block.number}
    block.weigh(len(docs), sum(sum(c.values()) for c in held), df)
    return row, block


def test_skips_windows(monkeypatch):
    """A rare term lifts the threshold, and most windows of the frequent terms are never scored."""
    docs = [(i, "common words here " + ("needle needle" if i < 10 else "x" * (i % 7 + 1) + " hay " * 30)) for i in range(5000)]
    row, block = block_of(docs, [(1, "common words needle")], monkeypatch, 256)
    seen = []
    window = lexical.LongList.window
    monkeypatch.setattr(lexical.LongList, "window", lambda self, w: seen.append(w) or window(self, w))
    shard = lexical.Shard({c: row.column(c)[0].as_py() for c in ("n_docs", "terms", "dfs", "lengths", "postings")}, block)
    top = lexical.Best(10)
    lexical.look(shard, block.terms[0].tolist(), top, row.column("ids")[0].values)
    assert [r[2] for r in top.rows] == list(range(10))
    assert len(shard.least) == 40 and len(set(seen)) <= 1


def test_bounds_hold(monkeypatch):
    docs = [(i, t) for i, t in some(2, 500, 40)[0] if t and terms_of(t) and i is not None]
    row, block = block_of(docs, [(1, "t0 t1 t2 t3 t4")], monkeypatch, 1)
    shard = lexical.Shard({c: row.column(c)[0].as_py() for c in ("n_docs", "terms", "dfs", "lengths", "postings")}, block)
    for term in block.terms[0].tolist():
        it = shard.long_list(term)
        for w in range(len(shard.least)):
            here, scores = it.window(w)
            assert it.bound[w] >= (scores.max() if len(scores) else 0)
            assert np.array_equal(it.at(w, here), scores)


def test_long_numbers():
    """Norms that pass 64 bits on the way are computed exactly."""
    block = lexical.Queries([(1, b"a")], pa.int64()).weigh(10**12, 10**15, {0: 5})
    index = {"n_docs": 2, "terms": zstandard.ZstdCompressor().compress(b"a"), "dfs": lexical.squeeze(np.array([2], np.uint64)),
             "lengths": lexical.squeeze(np.array([10**9, 7], np.uint64)), "postings": lexical.squeeze(np.array([0, 1], np.uint64), np.array([10**8, 7], np.uint64))}
    shard = lexical.Shard(index, block)
    assert shard.norm.tolist() == [10 + 90 * 10**9 * 10**12 // 10**15, 10]


def test_empty_and_other_columns(spark):
    docs, items = some(4, 20, 8)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []
    wide = spark.createDataFrame([(*r, {"x": 1}, 5) for r in docs], DOCS + ", `score.a` map<string,int>, rank int")
    asked = spark.createDataFrame([(*r, "q") for r in items], ITEMS + ", query string")
    got = lexical.search(lexical.build(wide), asked)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items)


def test_text_ids(spark):
    docs = spark.createDataFrame([("é", "a b"), ("z", "a b"), ("b", "a b"), (None, "a b"), ("c", "c")], "doc_id string, text string")
    got = lexical.search(lexical.build(docs), spark.createDataFrame([("q", "a")], "item_id string, text string"))
    assert [(r["query"], r["rank"], r["id"]) for r in got.orderBy("rank").collect()] == [("q", 1, "b"), ("q", 2, "z"), ("q", 3, "é"), ("q", 4, None)]
