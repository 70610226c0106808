"""Where the influence of the top artists comes from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scales import percent
from tributary.functions.text import readable
from tributary.operators.clusters import tag


def top_scored(scores: DataFrame, k: int, only_readable: bool = False) -> DataFrame:
    """(artist, authority_score) of the k best; unreadable names can be left out first."""
    if only_readable:
        scores = scores.where(readable(F.col("artist").cast("string")))
    return scores.orderBy(F.desc("authority_score"), "artist").limit(k)


def numbered(top: DataFrame) -> DataFrame:
    """Add `place` to a short top-k list."""
    best = Window.orderBy(F.desc("authority_score"), "artist")
    return top.withColumn("place", F.row_number().over(best))


def authority_context(edges: DataFrame, labels: DataFrame, scores: DataFrame, k: int = 15) -> DataFrame:
    """Incoming edges of the top artists split by whether the sampler shares the cluster.

    An end without a cluster makes the edge external. Artists without any edge
    stay in the list with nulls, in score order.
    """
    top = numbered(top_scored(scores, k, only_readable=True)).select("artist", "place")
    into = edges.select("src", "dst").join(
        F.broadcast(top.select(F.col("artist").alias("dst"))), "dst", "left_semi"
    )
    pairs = into.groupBy("src", "dst").agg(F.count("*").alias("n"))
    inside = F.when(F.col("src_cluster") == F.col("dst_cluster"), F.col("n")).otherwise(0)
    split = (
        tag(pairs, labels)
        .groupBy(F.col("dst").alias("artist"))
        .agg(F.sum("n").alias("total_samples"), F.sum(inside).alias("internal_samples"))
        .withColumn("external_samples", F.col("total_samples") - F.col("internal_samples"))
    )
    total = F.col("total_samples")
    return (
        top.join(split, "artist", "left")
        .select(
            "place",
            "artist",
            "total_samples",
            "internal_samples",
            "external_samples",
            percent(F.col("internal_samples"), total).alias("internal_pct"),
            percent(F.col("external_samples"), total).alias("external_pct"),
        )
        .orderBy("place")
    )


def top_connectivity(edges: DataFrame, scores: DataFrame, k: int = 15) -> DataFrame:
    """In, out and own edges of the top artists among themselves, with a class.

    All counts of all artists come from one aggregation.
    """
    top = numbered(top_scored(scores, k)).select("artist", "place")
    ends = F.broadcast(top.select("artist"))
    among = (
        edges.select("src", "dst")
        .join(ends.withColumnRenamed("artist", "src"), "src", "left_semi")
        .join(ends.withColumnRenamed("artist", "dst"), "dst", "left_semi")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )
    own = F.col("src") == F.col("dst")
    sides = F.explode(
        F.array(
            F.struct(F.col("dst").alias("artist"), F.lit("incoming").alias("side")),
            F.struct(F.col("src").alias("artist"), F.lit("outgoing").alias("side")),
        )
    )
    counted = (
        among.select(sides.alias("s"), own.alias("own"), "n")
        .groupBy("s.artist")
        .agg(
            F.sum(F.when((F.col("s.side") == "incoming") & ~F.col("own"), F.col("n"))).alias("incoming"),
            F.sum(F.when((F.col("s.side") == "outgoing") & ~F.col("own"), F.col("n"))).alias("outgoing"),
            F.sum(F.when((F.col("s.side") == "incoming") & F.col("own"), F.col("n"))).alias("self_loops"),
        )
    )
    joined = top.join(counted, "artist", "left").na.fill(0, ["incoming", "outgoing", "self_loops"])
    others = F.col("incoming") + F.col("outgoing")
    status = (
        F.when(others > 0, "Connected")
        .when(F.col("self_loops") > 0, "ISOLATED")
        .otherwise("COMPLETELY ISOLATED")
    )
    return joined.withColumn("status", status).orderBy("place")
