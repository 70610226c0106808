"""Louvain rounds over packed arcs: the outcome of the rounds by joins, in far fewer jobs."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tributary.operators import community, packed, pagerank


def mixed(groups=6, size=15, seed=1):
    """Groups that are not easy to tell apart, with weights that add up exactly."""
    rng, weight = random.Random(seed), {}
    n = groups * size
    for i in range(n):
        for _ in range(6):
            j = rng.randrange(n) if rng.random() < 0.4 else i // size * size + rng.randrange(size)
            if i != j:
                weight[min(i, j), max(i, j)] = weight.get((min(i, j), max(i, j)), 0.0) + rng.choice([0.5, 1.0, 2.0])
    return [(f"n{i:03d}", f"n{j:03d}", w) for (i, j), w in weight.items()]


def folded(spark, edges):
    return spark.createDataFrame(edges, "i string, j string, w double")


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


@pytest.fixture
def small_last_task(monkeypatch):
    """One task may settle 120 arcs, so that there are rounds."""
    monkeypatch.setattr(community, "ONE_TASK", 120 / community.block_rows.__globals__["BLOCK_ROWS"])


def test_draws_are_those_of_spark(spark):
    ids = np.random.default_rng(1).integers(-(2**62), 2**62, 50)
    table = packed.table(spark, {"id": ids})
    for number in (0, 42001, -5, 2**40):
        expected = dict(tuple(r) for r in table.select("id", F.xxhash64("id", F.lit(number))).collect())
        assert [expected[i] for i in ids.tolist()] == packed.hash_with(ids, number).view(np.int64).tolist()


def test_packed_rounds_are_those_of_the_joins(spark, small_last_task, monkeypatch):
    edges = mixed()
    ours, theirs = [], []
    found = rows(community.louvain(folded(spark, edges), arcs_read=ours))
    monkeypatch.setattr(community, "_of_few", None)
    spread = rows(community.louvain(folded(spark, edges), block=len({n for e in edges for n in e[:2]}) - 1, arcs_read=theirs))
    assert found == spread and ours == theirs and len(ours) > 4 and min(ours) <= 120 < max(ours)


def test_a_round_is_one_job(spark, small_last_task):
    """By joins a round took some fifteen jobs."""
    read, before = [], jobs(spark)
    community.louvain(folded(spark, mixed()), arcs_read=read).collect()
    assert len(read) > 4 and jobs(spark) - before <= 40 + 4 * len(read)


def test_arcs_without_weight_and_large_nodes_take_the_joins(spark, monkeypatch):
    monkeypatch.setattr(community, "_of_few", None)
    edges = [("a", "b", 1.0), ("b", "c", None), ("c", "d", 1.0)]
    assert len(rows(community.louvain(folded(spark, edges)))) == 4
    star = [("a", f"b{i}", 1.0) for i in range(6)] * 2
    assert len(rows(community.louvain(folded(spark, star), block=8))) == 7


def test_no_arcs_and_no_weight(spark):
    assert rows(community.louvain(folded(spark, []))) == []
    assert rows(community.louvain(folded(spark, [("a", "b", 0.0)]))) == [("a", 0, "a"), ("b", 1, "b")]


def test_blocks_hold_every_arc_once(spark):
    """Also with merging, which adds up equal arcs and sets a node's own weight apart; empty partitions make no block."""
    arcs = spark.createDataFrame([(5, 9, 1.0), (5, 9, 2.0), (9, 5, 4.0), (5, 5, 8.0)], "node long, other long, w double")
    ids = np.array([5, 7, 9])
    for merge, expected in ((False, {(5, 9): 3.0, (9, 5): 4.0, (5, 5): 8.0}), (True, {(5, 9): 3.0, (9, 5): 4.0})):
        blocks = packed.pack(packed.deal(arcs, ids, 8), len(ids), 8, merge)
        seen = packed.gathered(blocks, packed.PACKED)
        found = {}
        for a, b, w in zip(np.repeat(seen["near"], seen["degree"]), seen["other"], seen["w"]):
            found[int(ids[a]), int(ids[b])] = found.get((int(ids[a]), int(ids[b])), 0.0) + w
        assert found == expected and seen["inner"].sum() == (8.0 if merge else 0.0)
        assert len(seen["w"]) == (2 if merge else 4)
        blocks.unpersist()


def test_names_of_communities():
    at, strength = np.array([3, 1, 3, 1, 4]), np.array([1.0, 2.0, 1.0, 5.0, 0.0])
    cluster, top = packed.named(at, strength)
    assert cluster.tolist() == [0, 1, 0, 1, 2] and top.tolist() == [0, 3, 0, 3, 4]


def links(spark, n=60, seed=3):
    rng = random.Random(seed)
    pairs = {(f"n{rng.randrange(n)}", f"n{rng.randrange(n // 2)}") for _ in range(4 * n)}
    return spark.createDataFrame([(a, b, float(rng.choice([1, 2, 4]))) for a, b in sorted(pairs)], "src string, dst string, weight double")


def test_packed_ranks_are_those_of_the_joins(spark, monkeypatch):
    graph, packs = links(spark), []
    few = pagerank._of_few
    monkeypatch.setattr(pagerank, "_of_few", lambda *a: packs.append(1) or few(*a))
    before = jobs(spark)
    found = dict(rows(pagerank.pagerank(graph)))
    assert packs == [1] and jobs(spark) - before <= 45  # by joins over 70
    spread = dict(rows(pagerank.pagerank(graph, block=5)))
    assert packs == [1] and found == pytest.approx(spread, abs=1e-9) and sum(found.values()) == pytest.approx(len(found))


def test_ranks_of_odd_links_take_the_joins(spark, monkeypatch):
    """No name, no weight, or more arcs to one node than a block has rows."""
    monkeypatch.setattr(pagerank, "_of_few", None)
    odd = [("a", "b", 1.0), ("b", None, 1.0), ("c", "b", 2.0)], [("a", "b", 1.0), ("b", "a", None)]
    for graph, size in zip(odd, (4, 2)):
        assert len(rows(pagerank.pagerank(spark.createDataFrame(graph, "src string, dst string, weight double")))) == size
    star = [(f"s{i}", "b", 1.0) for i in range(9)] * 2
    assert len(rows(pagerank.pagerank(spark.createDataFrame(star, "src string, dst string, weight double"), block=10))) == 10
