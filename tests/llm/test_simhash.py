from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from conftest import rows
from tributary.llm import simhash


def brute(texts, shingle=3):
    """{row: (fingerprint, smallest row reachable)} by all pairs."""
    prints = {}
    for i, t in texts.items():
        w = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = [x for x in w.translate({c: 32 for c in range(9, 14)}).split(" ") if x]
        grams = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (prints[i], find(i)) for i in ids}


def some_texts():
    rng = np.random.default_rng(1)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 120)) for _ in range(12)]
    texts = {}
    for k, t in enumerate(base):
        for c in range(6):
            words = t.split()
            for _ in range(c):
                words[rng.integers(0, 120)] = f"n{rng.integers(0, 99)}"
            texts[10 * k + c] = " ".join(words)
    texts |= {200: None, 201: "", 202: " \n\t", 203: "One Two", 204: "one\ttwo", 205: "Ünï ÄB", 206: "x " * 3000}
    return texts


def test_groups_equal_all_pairs(spark):
    texts = some_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute(texts)
    for block in (simhash.BLOCK, 2):
        got = simhash.near_duplicates(df, block=block).select("id", simhash.hexadecimal("fingerprint"), "component")
        assert rows(got) == sorted(((i, f"{p:016x}", c) for i, (p, c) in expected.items()), key=repr)


def test_every_pair_within_three_bits_shares_an_anchor():
    rng = np.random.default_rng(2)
    for _ in range(400):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b ^= 1 << int(bit)
        pair = np.array([a, b], np.uint64).view(np.int64)
        seen = defaultdict(set)
        for row, key in zip(*simhash.anchors_of(pair)):
            seen[int(row)].add(int(key))
        assert seen[0] & seen[1]
        assert len(seen[0]) <= 34


def test_long_chain_is_one_group(spark):
    chain = [(1 << k) - 1 for k in range(0, 63)]
    df = spark.createDataFrame([(c,) for c in chain], "fingerprint long")
    found = simhash.components(simhash.links(df))
    assert {r for _, r in rows(found)} == {0}
    assert len(rows(found)) == len(chain) - 1


def test_repeated_rows_null_ids_and_extra_columns(spark):
    data = [(1, "a b c d", "x"), (1, "a b c d", "x"), (None, "a b c d", "y"), (7, "zz yy xx ww", "z")]
    df = spark.createDataFrame(data, "doc_id long, text string, fingerprint string")
    df = df.withColumn("component", F.lit(1)).withColumn("id", F.lit("q"))
    got = simhash.near_duplicates(df).select("id", "component")
    assert rows(got) == sorted([(1, 1), (1, 1), (None, 1), (7, 7)], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rows(simhash.near_duplicates(df)) == []
