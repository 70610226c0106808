import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tributary.operators import community, degree, links, pagerank, statistics, subgraph
from tributary.session import cut

TOY = [("B", "A"), ("C", "A"), ("D", "B"), ("E", "C"), ("D", "A")]


def link_table(spark, pairs):
    return spark.createDataFrame([(s, d, float(w)) for s, d, w in pairs], "src string, dst string, weight double")


def ranks_by_hand(pairs, damping=0.85, tolerance=0.01, steps=50):
    nodes = sorted({x for s, d, _ in pairs for x in (s, d)})
    out = defaultdict(float)
    for s, _, w in pairs:
        out[s] += w
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(steps):
        sunk = sum(r for n, r in rank.items() if n not in out)
        new = dict.fromkeys(nodes, (1 - damping) + damping * sunk / len(nodes))
        for s, d, w in pairs:
            new[d] += damping * rank[s] * w / out[s]
        moved = max(abs(new[n] - rank[n]) for n in nodes)
        rank = new
        if moved < tolerance:
            break
    return rank


GRAPHS = {
    "toy": [(s, d, 1) for s, d in TOY],
    "one link": [("a", "b", 0.5)],
    "two-cycle": [("a", "b", 1), ("b", "a", 2)],
    "star": [("hub", f"n{i}", 1 + i % 3) for i in range(40)] + [(f"n{i}", "hub", 1) for i in range(0, 40, 3)],
}


@pytest.mark.parametrize("name, forced", [*((n, {}) for n in GRAPHS), ("star", {"block": 2})])
def test_pagerank_by_hand(spark, name, forced):
    pairs = GRAPHS[name]
    expected = ranks_by_hand(pairs)
    got = {r["artist"]: r["authority_score"] for r in pagerank.pagerank(link_table(spark, pairs), **forced).collect()}
    assert got == pytest.approx(expected, abs=1e-9)
    assert sum(got.values()) == pytest.approx(len(expected), abs=1e-9)


def test_pagerank_of_nothing(spark):
    assert pagerank.pagerank(link_table(spark, [])).count() == 0


def test_toy_structure(spark):
    pairs = link_table(spark, GRAPHS["toy"])
    assert rows(links.sinks(pairs)) == [("A",)]
    assert rows(links.node_set(pairs)) == [(x,) for x in "ABCDE"]
    assert rows(degree.in_degree(pairs)) == [("A", 3), ("B", 1), ("C", 1)]
    assert rows(degree.out_degree(pairs)) == [("B", 1), ("C", 1), ("D", 2), ("E", 1)]


def test_unknown_artists_have_no_degree(spark):
    pairs = link_table(spark, [("[unknown]", "a", 1), ("a", "[unknown]", 1), ("b", "a", 1)])
    assert rows(degree.in_degree(pairs)) == [("a", 2)]
    assert rows(degree.known_degrees(pairs)) == [("a", 2, 1), ("b", 0, 1)]


def test_reciprocity_counts_self_pairs_once(spark):
    pairs = link_table(spark, [("a", "b", 1), ("b", "a", 1), ("a", "a", 1), ("a", "c", 1), ("a", "b", 1)])
    assert rows(statistics.reciprocity(pairs)) == [(3, 4, 0.75)]
    assert rows(statistics.reciprocity(link_table(spark, []))) == [(0, 0, 0.0)]


def test_log_histogram_keeps_empty_bins(spark):
    sizes = spark.createDataFrame([(1,), (1,), (10,), (100,)], "n int")
    got = dict(rows(degree.log_histogram(sizes, "n")))
    assert len(got) == 39 and got[0] == 2 and got[19] == 1 and got[38] == 1
    ones = dict(rows(degree.log_histogram(sizes.where("n = 1"), "n")))
    assert ones[38] == 2 and sum(ones.values()) == 2


def cliques():
    ring = [("c0n0", "c1n1"), ("c1n0", "c2n1"), ("c2n0", "c0n1")]
    inner = [(f"c{c}n{i}", f"c{c}n{j}") for c in range(3) for i in range(5) for j in range(i + 1, 5)]
    return [(min(p), max(p), 1.0) for p in inner + ring]


def folded(spark, edges, parts=2):
    return spark.createDataFrame(edges, "i string, j string, w double").repartition(parts)


def test_ring_of_cliques(spark):
    graph = folded(spark, cliques())
    labels = community.louvain(graph)
    groups = defaultdict(set)
    for r in labels.collect():
        groups[r["cluster_id"], r["representative"]].add(r["node"])
    expected = [{f"c{c}n{i}" for i in range(5)} for c in range(3)]
    assert [groups[k] for k in sorted(groups)] == expected
    assert [k[0] for k in sorted(groups)] == [0, 1, 2]
    assert community.modularity(graph, labels).first()[0] == pytest.approx(0.575758, abs=1e-6)


def planted(seed=5):
    random.seed(seed)
    found = {}
    for _ in range(900):
        a = random.randrange(120)
        b = (a // 20) * 20 + random.randrange(20) if random.random() < 0.8 else random.randrange(120)
        if a != b:
            pair = (f"v{min(a, b):03d}", f"v{max(a, b):03d}")
            found[pair] = found.get(pair, 0) + random.choice([0.5, 1.0])
    # One node is tied to everybody.
    for i in range(1, 120):
        found[("v000", f"v{i:03d}")] = found.get(("v000", f"v{i:03d}"), 0) + 0.5
    return [(i, j, w) for (i, j), w in found.items()]


def quality(edges, label):
    m = sum(w for _, _, w in edges)
    strength = defaultdict(float)
    for i, j, w in edges:
        strength[label[i]] += w
        strength[label[j]] += w
    inside = sum(w for i, j, w in edges if label[i] == label[j])
    return inside / m - sum(k * k for k in strength.values()) / (4 * m * m)


@pytest.fixture(scope="module")
def communities(spark):
    return rows(community.louvain(folded(spark, planted(), 2)))


def test_louvain_is_deterministic_and_finds_planted_groups(spark, communities):
    edges, plain = planted(), communities
    spread = rows(community.louvain(folded(spark, edges, 7), block=4))
    assert plain == spread
    labels = {n: c for n, c, _ in plain}
    groups = {n: int(n[1:]) // 20 for n in labels}
    assert quality(edges, labels) > quality(edges, groups) - 0.02
    measured = community.modularity(folded(spark, edges), spark.createDataFrame(list(labels.items()), "node string, cluster_id long"))
    assert measured.first()[0] == pytest.approx(quality(edges, labels), abs=1e-9)


def test_representative_is_strongest(communities):
    edges = planted()
    strength = defaultdict(float)
    for i, j, w in edges:
        strength[i] += w
        strength[j] += w
    members = defaultdict(list)
    for n, c, r in communities:
        members[c, r].append(n)
    for (_, r), nodes in members.items():
        assert r == min(nodes, key=lambda n: (-strength[n], n))


def test_ego_and_adjacency(spark):
    pairs = link_table(spark, [("a", "b", 2), ("c", "a", 1), ("a", "a", 5), ("b", "c", 1)])
    got = [tuple(r) for r in subgraph.ego(pairs, "a").collect()]
    assert got == [("in", "a", 5.0), ("in", "c", 1.0), ("out", "a", 5.0), ("out", "b", 2.0)]
    nodes = spark.createDataFrame([("a",), ("c",), ("x",)], "id string")
    assert rows(subgraph.adjacent(pairs, "b", nodes)) == [("a", True), ("c", True), ("x", False)]
    assert rows(subgraph.adjacent(pairs, "x", nodes)) == [("a", False), ("c", False), ("x", True)]


def test_node_sizes_of_equal_scores(spark):
    same = spark.createDataFrame([("a", 2.0), ("b", 2.0)], "id string, authority_score double")
    assert {r["node_size"] for r in subgraph.node_sizes(same).collect()} == {800.0}


def one_by_one(edges, seed):
    """Sequential Louvain: nodes in random order, each to the best neighbour community, until none gains; then again on the communities."""
    rng = random.Random(seed)
    near, own = defaultdict(dict), defaultdict(float)
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    m2, member = 2 * sum(w for _, _, w in edges), {n: n for n in near}
    while True:
        nodes = sorted(near)
        k = {n: sum(near[n].values()) + own[n] for n in nodes}
        comm, total, moved_any, moved = {n: n for n in nodes}, dict(k), False, True
        rng.shuffle(nodes)
        while moved:
            moved = False
            for n in nodes:
                to = defaultdict(float)
                for o, w in near[n].items():
                    to[comm[o]] += w
                home = comm[n]
                total[home] -= k[n]
                best = max(sorted({*to, home}), key=lambda c: (to[c] - k[n] * total[c] / m2, c == home))
                if to[best] - k[n] * total[best] / m2 <= to[home] - k[n] * total[home] / m2 + 1e-12:
                    best = home
                total[best] += k[n]
                if best != home:
                    comm[n], moved, moved_any = best, True, True
        member = {n: comm[c] for n, c in member.items()}
        if not moved_any:
            return member
        merged, inner = defaultdict(lambda: defaultdict(float)), defaultdict(float)
        for n in near:
            inner[comm[n]] += own[n]
            for o, w in near[n].items():
                if comm[n] == comm[o]:
                    inner[comm[n]] += w
                else:
                    merged[comm[n]][comm[o]] += w
        near, own = {c: dict(merged[c]) for c in set(comm.values())}, inner


def test_louvain_is_as_good_as_one_by_one_sweeps(spark):
    """At or above the mean of five one-by-one runs on three graphs."""
    from parity import queries

    folder = "/root/testdata/sf0.001"
    for graph in (queries.folded(spark, folder), queries.folded(spark, folder, "dense"), folded(spark, planted(), 2)):
        plain = [tuple(r) for r in graph.collect()]
        mean = sum(quality(plain, one_by_one(plain, seed)) for seed in range(5)) / 5
        read = []
        found = rows(community.louvain(graph, arcs_read=read), "node", "cluster_id")
        assert quality(plain, dict(found)) >= mean and read[0] == 2 * len(plain)


def first_level(spark):
    edges = [(int(i[1:]), int(j[1:]), w) for i, j, w in planted()]
    arcs = cut(links.both_ways(spark.createDataFrame(edges, "i long, j long, w double")).select("node", "other", "w"))
    nodes = arcs.groupBy(F.col("node").alias("id")).agg(F.sum("w").alias("k"), F.lit(0.0).alias("own"), F.count("*").alias("links"))
    return edges, community._Level(cut(nodes), arcs, None), 2 * sum(w for _, _, w in edges)


def test_a_level_ends_when_no_node_gains(spark, monkeypatch):
    """By rounds of independent moves and a last task: no single move raises the modularity, and rounds read fewer and fewer arcs."""
    edges, level, two_m = first_level(spark)
    monkeypatch.setattr(community, "block_rows", lambda spark: 225)
    read = []
    state, moved = level.settle(two_m, 1.0, 42, read)
    label = {r["id"]: r["comm"] for r in state.collect()}
    level.close()
    assert moved and read[0] == 2 * len(edges) and min(read) <= 900 < read[0]
    reached = quality(edges, label)
    for node in label:
        for other in set(label.values()):
            assert quality(edges, label | {node: other}) <= reached + 1e-9


def test_independent_moves_never_lose(spark):
    """Every round of granted wishes raises the modularity by what was promised at least."""
    edges, level, two_m = first_level(spark)
    state = cut(level.nodes.withColumn("comm", F.col("id")).withColumn("active", F.lit(True)))
    label = {r["id"]: r["comm"] for r in state.collect()}
    for coin in range(2):
        wishes = cut(level.wishes(state, two_m, 1.0))
        state = cut(level.moved(state, level.independent(wishes, two_m, 1.0, coin, False), wishes))
        seen, before = level.judged(state, two_m, 1.0), quality(edges, label)
        label = {r["id"]: r["comm"] for r in state.collect()}
        assert seen["moved"] > 0 and quality(edges, label) >= before + 2 * seen["gained"] / two_m - 1e-9
    level.close()


def test_a_round_moves_no_arcs_for_few_nodes(spark):
    """Without any broadcast by size: what is known of the nodes goes to the arcs, and the wishes and their grants are those of the joins that spread."""
    edges, level, two_m = first_level(spark)
    state = cut(level.nodes.withColumn("comm", F.col("id") % 40).withColumn("active", F.col("id") % 3 > 0))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {}
    try:
        for level.few in (True, False):
            wishes = level.wishes(state, two_m, 1.0)
            plan = wishes._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) is not level.few
            granted = level.independent(wishes, two_m, 1.0, 0, False)
            found[level.few] = rows(wishes), rows(granted), rows(level.moved(state.withColumn("was", F.lit(0)).withColumn("gained", F.lit(0)), granted, wishes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        level.close()
    assert found[True] == found[False] and all(found[True])
