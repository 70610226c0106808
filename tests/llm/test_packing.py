import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import rows
from tributary.llm import packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, size):
    """Capacities left by best-fit decreasing, a document at a time."""
    open_ = []
    for n in sorted(lengths, reverse=True):
        fits = [(c, k) for k, c in enumerate(open_) if c >= n]
        if fits:
            open_[min(fits)[1]] -= n
        else:
            open_.append(size - n)
    return sorted(open_)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    used, counts = defaultdict(int), Counter(lengths)
    for length, _, count, first, each, at in sorted(packing.plan(counts, 20), key=lambda r: -r[0]):
        for i in range(count):
            here = first + i // each
            assert used[here] == at + i % each * length
            used[here] += length
    assert sorted(20 - u for u in used.values()) == one_by_one(lengths, 20)


def test_capacities_finds_the_tightest():
    rng = np.random.default_rng(3)
    tree, there = packing.Capacities(50), set()
    for _ in range(500):
        c = int(rng.integers(0, 51))
        there ^= {c}
        tree.set(c, c in there)
        n = int(rng.integers(1, 51))
        assert tree.at_least(n) == min((x for x in there if x >= n), default=None)


def test_documents_come_back_whole(spark):
    whole = Tokenizer.from_file(BYTES)
    rng = np.random.default_rng(4)
    data = [(k, " ".join(f"w{x}" for x in rng.integers(0, 99, int(n))), k) for k, n in enumerate(rng.integers(0, 60, 80))]
    data += [(900, None, 0), (901, "", 0), (902, "long text " * 300, 0), (902, "long text " * 300, 0), (None, "x", 0)]
    df = spark.createDataFrame(data, "doc_id long, text string, length long").repartition(3)
    packed = packing.pack(packing.pieces(df, BYTES, size=64), 64).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in packed:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["id"]].append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(64 - sum(n for _, n in s) for s in by_sequence.values()) == one_by_one([r["length"] for r in packed], 64)
    for i, text, _ in data:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        found = sorted(set(by_doc[i]))
        assert b"".join(p[3] for p in found) == np.array(ids, "<u4").tobytes()
        assert [p[1] for p in found] == [0, *range(len(ids) % 64 or 64, len(ids), 64)]
        assert all(len(p[3]) == 4 * p[2] for p in found) and (len(ids) > 64 or len(found) == 1)
    assert len(by_doc[902]) == 2 * len(set(by_doc[902]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rows(packing.pack(packing.pieces(df, BYTES))) == []


def test_checksum_is_of_the_ids(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    r = packing.pieces(df, BYTES).select("ids", F.crc32("ids").alias("c")).first()
    assert r["c"] == zlib.crc32(bytes(r["ids"]))
