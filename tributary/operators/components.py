"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.skew import spread_join
from tributary.session import cut, discard


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of pairs (a, b): root is the smallest node of its component.

    Every step ties each node's larger neighbours to its smallest one, then its smaller ones too, which halves long
    chains; the pairs end as stars around the roots. Pairs are written after each step, so a lost executor
    costs one step; a hub's pairs are spread over blocks while its smallest neighbour is looked up.
    """
    mirrored = lambda p: p.unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = cut(mirrored(pairs.select("a", "b")).select(F.col("a").alias("node")).distinct())
    now = cut(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    shape = None
    while True:
        around = cut(mirrored(now))
        least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        upward = spread_join(around.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = cut(upward)
        below = large.groupBy("a").agg(F.min("b").alias("low"))
        tied = spread_join(large, below, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("p"))
        after = cut(tied.select("p.a", "p.b").where("a <> b").distinct())
        then = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(now, around, large)
        now = after
        if then == shape or not then[0]:
            break
        shape = then
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
