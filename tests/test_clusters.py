from conftest import rows
from pyspark.sql import functions as F

from tributary.operators import clusters, context

EDGES = [("a", "b"), ("a", "b"), ("b", "a"), ("a", "c"), ("c", "d"), ("x", "a"), ("d", "x")]
LABELS = [("a", 0, "a"), ("b", 0, "a"), ("c", 1, "c"), ("d", 1, "c"), ("e", 2, "e")]


def tables(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    labels = spark.createDataFrame(LABELS, "node string, cluster_id long, representative string")
    return edges, labels


def test_edge_mix_adds_up(spark):
    edges, labels = tables(spark)
    flows = clusters.flow(edges, labels)
    mix = clusters.mix(flows).first()
    assert (mix["intra_cluster_edges"], mix["inter_cluster_edges"], mix["unclustered_edges"]) == (4, 1, 2)
    assert mix["total_edges"] == len(EDGES)
    assert mix["cohesion"] == "tight"
    bridges = clusters.bridges(flows, labels)
    assert rows(bridges) == [("a", "c", 1)]
    assert bridges.agg(F.sum("Connection_Strength")).first()[0] == mix["inter_cluster_edges"]


def test_density_may_pass_one_and_is_zero_for_singletons(spark):
    edges, labels = tables(spark)
    got = {r[0]: r[1:] for r in rows(clusters.densest(clusters.flow(edges, labels), labels))}
    assert got == {"a": (2, 3, 1.5), "c": (2, 1, 0.5), "e": (1, 0, 0.0)}


def test_size_summary(spark):
    sized = spark.createDataFrame([("a", 1), ("b", 2), ("c", 10), ("d", 300)], "representative string, size long")
    one = clusters.size_summary(sized).first()
    assert (one["num_clusters"], one["total_nodes"], one["median_size"]) == (4, 313, 6.0)
    assert clusters.size_summary(sized.where("size = 1")).first()["stddev_size"] == 0.0
    assert tuple(clusters.size_classes(sized).first()) == (1, 2, 0, 0, 1)


def test_cluster_labels_fall_back(spark):
    _, labels = tables(spark)
    scores = spark.createDataFrame([("b", 3.0), ("a", 1.0), ("c", 2.0), ("d", 2.0)], "artist string, authority_score double")
    got = {r["representative"]: (r["artist"], r["label"]) for r in clusters.top_artist(labels, scores).collect()}
    assert got == {"a": ("b", "b Cluster"), "c": ("c", "c Cluster"), "e": (None, "Cluster e")}


def test_top_members_limit_before_the_shuffle(spark):
    _, labels = tables(spark)
    scores = spark.createDataFrame([("b", 3.0), ("a", 1.0), ("c", 2.0)], "artist string, authority_score double")
    best = clusters.top_members(labels, scores, 2, 1)
    assert rows(best, "representative", "node") == [("a", "b"), ("c", "c")]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_context_keeps_the_order_and_counts_unknown_as_external(spark):
    edges, labels = tables(spark)
    scores = spark.createDataFrame([("a", 3.0), ("zzz", 2.0), ("x", 1.0), ("bad\tname", 9.0)], "artist string, authority_score double")
    got = [tuple(r) for r in context.authority_context(edges, labels, scores, 3).collect()]
    assert got == [
        (1, "a", 2, 1, 1, 50.0, 50.0),
        (2, "zzz", None, None, None, None, None),
        (3, "x", 1, 0, 1, 0.0, 100.0),
    ]


def test_connectivity_classes(spark):
    edges = spark.createDataFrame([("a", "a"), ("b", "c"), ("a", "z")], "src string, dst string")
    scores = spark.createDataFrame([(n, s) for n, s in zip("abcd", (4.0, 3.0, 2.0, 1.0))], "artist string, authority_score double")
    got = {r["artist"]: (r["incoming"], r["outgoing"], r["self_loops"], r["status"]) for r in context.top_connectivity(edges, scores).collect()}
    assert got == {
        "a": (0, 0, 1, "ISOLATED"),
        "b": (0, 1, 0, "Connected"),
        "c": (1, 0, 0, "Connected"),
        "d": (0, 0, 0, "COMPLETELY ISOLATED"),
    }
