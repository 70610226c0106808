"""Cut-outs of the artist graph: induced, core and ego networks, search and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scales import line_width, radius_scale, root_scale, stroke_width
from tributary.functions.text import contains_ignoring_case
from tributary.operators.clusters import largest, top_members
from tributary.operators.context import top_scored
from tributary.operators.degree import known, known_degrees
from tributary.operators.links import collapse, collapse_count, known_names
from tributary.operators.skew import Chain, spread_join
from tributary.session import cut


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends in nodes(id); ids occur once, so plain joins keep the edges as they are."""
    inside = Chain(edges, "src", "dst").join(nodes.select(F.col("id").alias("src")), "src").join(nodes.select(F.col("id").alias("dst")), "dst")
    return inside.df.select(edges.columns)


def induced_by_few(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The same for a top-k list, whose length the caller has bounded."""
    few = F.broadcast(nodes.select("id"))
    inside = edges.join(few.withColumnRenamed("id", "src"), "src", "left_semi")
    return inside.join(few.withColumnRenamed("id", "dst"), "dst", "left_semi").select(edges.columns)


def degree_within(sub: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, degree) inside a cut-out; nodes without an edge keep 0."""
    touched = sub.select(F.explode(F.array("src", "dst")).alias("id"))
    counted = touched.groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(counted, "id", "left").na.fill(0, ["degree"])


def cluster_of(labels: DataFrame, key: str, column: str) -> DataFrame:
    """Label lookup table under other column names; clusters as text."""
    return labels.select(
        F.col("node").alias(key), F.col("representative").cast("string").alias(column)
    )


def labels_of_few(labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """The labels of a top-k list of nodes(id)."""
    few = F.broadcast(nodes.select(F.col("id").alias("node")))
    return labels.join(few, "node", "left_semi")


def with_cluster(df: DataFrame, labels: DataFrame, key: str = "id", column: str = "cluster") -> DataFrame:
    found = spread_join(df, cluster_of(labels, key, column), key, "left")
    return found.na.fill("Unknown", [column])


def edge_class(sub: DataFrame, labels: DataFrame) -> DataFrame:
    """Add `edge_class`: intra if both ends share a known cluster, else inter."""
    tagged = Chain(sub, "src", "dst")
    for key in ("src", "dst"):
        tagged.join(cluster_of(labels, key, f"{key}_cluster"), key, "left")
    tagged = tagged.df.na.fill("Unknown", ["src_cluster", "dst_cluster"])
    same = (F.col("src_cluster") == F.col("dst_cluster")) & (F.col("src_cluster") != "Unknown")
    return tagged.withColumn("edge_class", F.when(same, "intra").otherwise("inter"))


def top_network(
    edges: DataFrame, scores: DataFrame, labels: DataFrame, top: int = 50, min_weight: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Nodes and links among the best-scored artists, ready to draw.

    Links are weighted by their number of edges. All `top` artists stay, linked or not.
    """
    best = top_scored(scores, top).withColumnRenamed("artist", "id")
    pairs = collapse_count(induced_by_few(edges.select("src", "dst"), best), min_weight)
    labels = labels_of_few(labels, best)
    nodes = with_cluster(node_sizes(best), labels).join(degree_within(pairs, best), "id")
    return nodes, edge_widths(edge_class(pairs, labels))


def core_nodes(
    edges: DataFrame,
    scores: DataFrame,
    labels: DataFrame,
    by_score: int = 200,
    by_degree: int = 100,
    clusters: int = 20,
    members: int = 5,
    both: DataFrame | None = None,
) -> DataFrame:
    """core(id, authority_score, cluster): leaders by four measures that have a score.

    Each list is a top-k, so the union has a fixed upper size and is written once
    for the readers. Both degrees come from one table, `both` if it is known already. The placeholder artist takes
    no place among the leaders; on built graphs it does not occur.
    """
    both = known_degrees(edges) if both is None else known(both, "artist")
    reach = F.explode(F.array(F.struct(F.lit("in").alias("d"), F.col("in_degree").alias("n")), F.struct(F.lit("out").alias("d"), F.col("out_degree").alias("n"))))
    sides = both.select("artist", reach.alias("r")).where("r.n > 0").select("artist", "r.d", "r.n")
    leaders = most_by(sides, by_degree)
    chosen = (
        top_scored(scores, by_score).select(F.col("artist").alias("id"))
        .unionByName(leaders.select(F.col("artist").alias("id")))
        .unionByName(top_members(labels, scores, clusters, members).select(F.col("node").alias("id")))
        .distinct()
    )
    as_text = chosen.withColumn("name", F.col("id").cast("string"))
    kept = F.broadcast(cut(known_names(as_text, "name").select("id")))
    ranked = scores.withColumnRenamed("artist", "id").join(kept, "id", "left_semi")
    named = F.broadcast(cluster_of(labels_of_few(labels, kept), "id", "cluster"))
    return cut(ranked.join(named, "id", "left").na.fill("Unknown", ["cluster"]))


def most_by(sides: DataFrame, k: int) -> DataFrame:
    """The k artists of the highest n for each d; the limit bounds what reaches one task per d."""
    rank = F.row_number().over(Window.partitionBy("d").orderBy(F.desc("n"), "artist"))
    return sides.withColumn("place", rank).where(F.col("place") <= k).drop("place")


def core_links(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Summed links between core nodes; the node list is short by construction."""
    return collapse(induced_by_few(edges.select("src", "dst", "weight"), nodes))


def core_bundle(edges: DataFrame, scores: DataFrame, labels: DataFrame, both: DataFrame | None = None) -> DataFrame:
    """(kind, json) rows of the explorer's input: nodes, links and the largest clusters; `both` as for core_nodes."""
    nodes = core_nodes(edges, scores, labels, both=both)
    links = core_links(edges, nodes)
    node = F.to_json(F.struct("id", F.col("authority_score").alias("pagerank"), "cluster"))
    link = F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), "weight"))
    place = F.row_number().over(Window.orderBy(F.desc("size"), "representative"))  # over 20 rows
    cluster = F.to_json(F.struct("rank", "representative"))
    return (
        nodes.select(F.lit("node").alias("kind"), node.alias("json"))
        .unionByName(links.select(F.lit("link").alias("kind"), link.alias("json")))
        .unionByName(largest(labels, 20).withColumn("rank", place).select(F.lit("cluster").alias("kind"), cluster.alias("json")))
    )


def ego(links: DataFrame, id) -> DataFrame:
    """Neighbours of one node with direction and weight, heaviest first."""
    near = links.where((F.col("src") == F.lit(id)) | (F.col("dst") == F.lit(id)))
    sides = F.explode(
        F.filter(
            F.array(
                F.struct(F.lit("in").alias("direction"), F.col("dst").alias("self"), F.col("src").alias("neighbour")),
                F.struct(F.lit("out").alias("direction"), F.col("src").alias("self"), F.col("dst").alias("neighbour")),
            ),
            lambda s: s["self"] == F.lit(id),
        )
    )
    found = near.select(sides.alias("s"), "weight").select("s.direction", "s.neighbour", "weight")
    return found.orderBy("direction", F.desc("weight"), "neighbour")


def adjacent(links: DataFrame, id, nodes: DataFrame) -> DataFrame:
    """(id, connected): is each of the nodes the given one or linked to it in either direction?"""
    near = ego(links, id).select(F.col("neighbour").alias("id"), F.lit(True).alias("linked")).distinct()
    found = nodes.select("id").join(near, "id", "left")
    return found.select("id", (F.coalesce("linked", F.lit(False)) | (F.col("id") == F.lit(id))).alias("connected"))


def search(nodes: DataFrame, term: str, column: str = "id") -> DataFrame:
    return nodes.where(contains_ignoring_case(F.col(column).cast("string"), term))


def of_cluster(nodes: DataFrame, cluster) -> DataFrame:
    return nodes.where(F.col("cluster") == F.lit(cluster))


def links_of_cluster(links: DataFrame, labels: DataFrame, cluster) -> DataFrame:
    """Links with both ends in the cluster."""
    members = labels.where(F.col("representative").cast("string") == F.lit(str(cluster)))
    return induced(links, members.select(F.col("node").alias("id")))


def node_sizes(nodes: DataFrame) -> DataFrame:
    """Add display sizes by score: `node_size` and `radius`."""
    low = nodes.agg(F.min("authority_score")).scalar()
    high = nodes.agg(F.max("authority_score")).scalar()
    score = F.col("authority_score")
    return nodes.withColumns(
        {"node_size": root_scale(score, low, high), "radius": radius_scale(score, high)}
    )


def edge_widths(links: DataFrame) -> DataFrame:
    """Add display widths by weight: `line_width` and `stroke_width`."""
    heaviest = links.agg(F.max("weight")).scalar()
    return links.withColumns(
        {
            "line_width": line_width(F.col("weight"), heaviest),
            "stroke_width": stroke_width(F.col("weight")),
        }
    )


def legend(nodes: DataFrame, k: int = 10) -> DataFrame:
    """Node counts of the k clusters shown most, the unknown ones in an extra row."""
    counted = nodes.groupBy("cluster").agg(F.count("*").alias("nodes"))
    shown = counted.where(F.col("cluster") != "Unknown").orderBy(F.desc("nodes"), "cluster").limit(k)
    return shown.unionByName(counted.where(F.col("cluster") == "Unknown"))
