"""Quality of a clustering: sizes, cohesion, density and bridges.

`labels` holds (node, cluster_id, representative), one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scales import ratio
from tributary.functions.text import readable
from tributary.operators.skew import Chain
from tributary.operators.statistics import long_report
from tributary.session import cut


def sizes(labels: DataFrame) -> DataFrame:
    """(representative, size)."""
    return labels.groupBy("representative").agg(F.count("*").alias("size"))


def largest(labels: DataFrame, k: int) -> DataFrame:
    return sizes(labels).orderBy(F.desc("size"), "representative").limit(k)


def strongest_member(labels: DataFrame, strengths: DataFrame) -> DataFrame:
    """(cluster_id, representative): the member of highest weighted degree, names break ties."""
    known = labels.select("node", "cluster_id").join(strengths, "node", "left")
    order = F.struct((-F.coalesce("wdeg", F.lit(0.0))).alias("falling"), F.col("node"))
    return known.groupBy("cluster_id").agg(F.min(order)["node"].alias("representative"))


def size_summary(sized: DataFrame) -> DataFrame:
    """One row: count, total, min, max, mean, deviation (0 for one cluster) and median.

    The median reads the table of distinct sizes, which stays short.
    """
    distinct = sized.groupBy("size").agg(F.count("*").alias("n"))
    middle = distinct.agg(F.expr("percentile(size, 0.5, n)")).scalar()
    return sized.agg(
        F.count("*").alias("num_clusters"),
        F.sum("size").alias("total_nodes"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.avg("size").alias("avg_size"),
        F.coalesce(F.stddev_samp("size"), F.lit(0.0)).alias("stddev_size"),
    ).withColumn("median_size", middle)


def size_classes(sized: DataFrame) -> DataFrame:
    """One row: clusters per size class."""
    size = F.col("size")
    return sized.agg(
        F.count_if(size == 1).alias("singleton"),
        F.count_if(size.between(2, 10)).alias("small"),
        F.count_if(size.between(11, 50)).alias("medium"),
        F.count_if(size.between(51, 200)).alias("large"),
        F.count_if(size > 200).alias("giant"),
    )


def pair_counts(edges: DataFrame) -> DataFrame:
    """Parallel edges counted before anything is joined to them."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("n"))


def tag(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Add src_cluster and dst_cluster; null for ends without a label."""
    source = labels.select(F.col("node").alias("src"), F.col("cluster_id").alias("src_cluster"))
    target = labels.select(F.col("node").alias("dst"), F.col("cluster_id").alias("dst_cluster"))
    return Chain(pairs, "src", "dst").join(source, "src", "left").join(target, "dst", "left").df


def flow(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edge counts between clusters: (src_cluster, dst_cluster, n), nulls as their own group.

    Everything on mixing, cohesion and bridges reads this small table.
    """
    tagged = tag(pair_counts(edges), labels)
    return tagged.groupBy("src_cluster", "dst_cluster").agg(F.sum("n").alias("n"))


def mix(flows: DataFrame) -> DataFrame:
    """One row: edges inside, between and outside clusters, with the inside share and its grade."""
    same = F.col("src_cluster") == F.col("dst_cluster")
    loose = F.col("src_cluster").isNull() | F.col("dst_cluster").isNull()

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counted = flows.agg(
        total(same).alias("intra_cluster_edges"),
        total(~same).alias("inter_cluster_edges"),
        total(loose).alias("unclustered_edges"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_edges"),
    )
    every = F.col("total_edges")
    graded = counted.select(
        "*",
        (100 * ratio(F.col("intra_cluster_edges"), every)).alias("intra_pct"),
        (100 * ratio(F.col("inter_cluster_edges"), every)).alias("inter_pct"),
        (100 * ratio(F.col("unclustered_edges"), every)).alias("unclustered_pct"),
        ratio(F.col("intra_cluster_edges"), every).alias("intra_cluster_edge_fraction"),
    )
    share = F.col("intra_cluster_edge_fraction")
    grade = (
        F.when(share > 0.5, "tight")
        .when(share > 0.3, "moderate")
        .when(share > 0.15, "some")
        .otherwise("low")
    )
    return graded.withColumn("cohesion", grade)


def names_of(labels: DataFrame) -> DataFrame:
    """(cluster_id, representative) once per cluster."""
    return labels.select("cluster_id", "representative").distinct()


def densest(flows: DataFrame, labels: DataFrame, k: int = 5) -> DataFrame:
    """Inner edges and density of the k largest clusters; parallel edges count, so it may pass 1."""
    top = (
        labels.groupBy("cluster_id", "representative")
        .agg(F.count("*").alias("size"))
        .orderBy(F.desc("size"), "representative")
        .limit(k)
    )
    inside = flows.where(F.col("src_cluster") == F.col("dst_cluster")).select(
        F.col("src_cluster").alias("cluster_id"), F.col("n").alias("internal_edges")
    )
    possible = F.col("size") * (F.col("size") - 1)
    return (
        top.join(inside, "cluster_id", "left")
        .na.fill(0, ["internal_edges"])
        .select("representative", "size", "internal_edges", ratio(F.col("internal_edges"), possible).alias("density"))
    )


def bridges(flows: DataFrame, labels: DataFrame) -> DataFrame:
    """(From_Cluster, To_Cluster, Connection_Strength), strongest first."""
    names = names_of(labels)
    source = names.select(F.col("cluster_id").alias("src_cluster"), F.col("representative").alias("From_Cluster"))
    target = names.select(F.col("cluster_id").alias("dst_cluster"), F.col("representative").alias("To_Cluster"))
    between = flows.where(F.col("src_cluster") != F.col("dst_cluster"))
    named = Chain(between, "src_cluster", "dst_cluster").join(source, "src_cluster").join(target, "dst_cluster")
    return named.df.select(
        "From_Cluster", "To_Cluster", F.col("n").alias("Connection_Strength")
    ).orderBy(F.desc("Connection_Strength"), "From_Cluster", "To_Cluster")


def quality_summary(edges: DataFrame, labels: DataFrame, flows: DataFrame | None = None) -> DataFrame:
    """The long (metric, value) report on a clustering; from `flows` if they are known already."""
    sized = size_summary(sizes(labels)).select("num_clusters", "avg_size", "max_size")
    mixed = mix(flow(edges, labels) if flows is None else flows)
    return long_report(
        sized.withColumnsRenamed({"avg_size": "avg_cluster_size", "max_size": "max_cluster_size"}),
        mixed.select(
            "intra_cluster_edge_fraction",
            "intra_cluster_edges",
            "inter_cluster_edges",
            "unclustered_edges",
        ),
    )


def scored(labels: DataFrame, scores: DataFrame, how: str) -> DataFrame:
    return labels.join(scores.withColumnRenamed("artist", "node"), "node", how)


def top_artist(labels: DataFrame, scores: DataFrame) -> DataFrame:
    """(representative, size, artist, label): the best-scored artist of every cluster.

    Size and winner come out of one aggregation; artists without a score lose
    to all others, and equal scores fall to the smaller name.
    """
    order = F.struct(
        F.col("authority_score").isNull().alias("unscored"),
        (-F.col("authority_score")).alias("falling"),
        F.col("node"),
    )
    best = (
        scored(labels, scores, "left")
        .groupBy("representative")
        .agg(F.count("*").alias("size"), F.min(order).alias("best"))
        .select(
            "representative",
            "size",
            F.when(~F.col("best.unscored"), F.col("best.node")).alias("artist"),
        )
    )
    shown = F.when(
        readable(F.col("artist").cast("string")), F.concat(F.col("artist").cast("string"), F.lit(" Cluster"))
    ).otherwise(F.concat(F.lit("Cluster "), F.col("representative").cast("string")))
    return best.withColumn("label", shown)


def top_members(labels: DataFrame, scores: DataFrame, clusters: int = 20, members: int = 5) -> DataFrame:
    """(representative, node, authority_score, place) for the best of the largest clusters.

    The rank filter sits on the window, so each task keeps only `members` rows
    per cluster before the shuffle.
    """
    top = F.broadcast(largest(labels, clusters).select("representative"))
    best = Window.partitionBy("representative").orderBy(F.desc("authority_score"), "node")
    return (
        scored(labels.join(top, "representative", "left_semi"), scores, "inner")
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= members)
        .select("representative", "node", "authority_score", "place")
    )
