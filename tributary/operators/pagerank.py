"""Weighted PageRank whose ranks add up to the number of nodes."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators import packed
from tributary.operators.skew import block_size, hot_table, key_hash, positions, salt_rows
from tributary.session import block_rows, cut, discard, layout_width


def hot_sources(giving: DataFrame, total: int, block: int | None = None) -> list[tuple[int, int]]:
    """Exact hot list from giving(id, links), whose links add up to `total`."""
    block = block_size(giving.sparkSession, total, block)
    if total <= block:
        return []
    blocks = F.ceil(F.col("links") / F.lit(block)).cast("int")
    rows = giving.where(F.col("links") > block).select(F.xxhash64("id").alias("h"), blocks.alias("b"))
    return [(r["h"], r["b"]) for r in rows.collect()]  # fewer than total / block rows


def pagerank(
    links: DataFrame,
    damping: float = 0.85,
    tolerance: float = 0.01,
    max_iterations: int = 50,
    block: int | None = None,
) -> DataFrame:
    """(artist, authority_score) over links(src, dst, weight).

    Every node starts at 1. The mass held by nodes without outgoing links is
    shared out evenly; the loop ends once no rank moves by `tolerance`, or warns
    that `max_iterations` were too few for that.

    The links are laid out once by (source, block) and kept; a step ships only
    the ranks. Contributions are summed on the map side before they move, so a
    popular target costs one row per task, and a prolific source is spread over
    its blocks. The driver sees two numbers per step.
    """
    spark = links.sparkSession
    ends = F.explode(
        F.array(
            F.struct(F.col("src").alias("id"), F.col("weight").alias("w"), F.lit(1).alias("one")),
            F.struct(F.col("dst").alias("id"), F.lit(None).cast("double").alias("w"), F.lit(0).alias("one")),
        )
    )
    ranks = cut(
        links.select(ends.alias("e"))
        .groupBy("e.id")
        .agg(F.sum("e.w").alias("gives"), F.sum("e.one").alias("links"), F.count("e.w").alias("weights"), F.count_if(F.col("e.one") == 0).alias("into"))
        .withColumn("rank", F.lit(1.0))
        .withColumn("moved", F.lit(0.0))
    )
    start = ranks.agg(
        F.count("*").alias("n"),
        F.sum("links").alias("links"),
        F.count("id").alias("known"),
        F.sum("weights").alias("weights"),
        F.max("into").alias("into"),
        F.count_if(F.col("gives") == 0).alias("empty"),
        F.coalesce(F.sum(F.when(F.col("gives").isNull(), 1.0)), F.lit(0.0)).alias("sunk"),
    ).first()
    n, sunk = start["n"], start["sunk"]
    if n == 0:
        return ranks.select(F.col("id").alias("artist"), F.col("rank").alias("authority_score"))

    most = block or block_rows(spark)
    if n <= most and start["into"] <= most and start["known"] == n and start["weights"] == start["links"] and not start["empty"]:
        return _of_few(links, ranks, start["links"], damping, tolerance, max_iterations)
    ranks = ranks.drop("weights", "into")
    hot = hot_sources(ranks, start["links"], block)
    id_type = ranks.schema["id"].dataType
    # an arc from nowhere carries no rank
    arcs = links.where(F.col("src").isNotNull()).select(F.col("src").cast(id_type), F.col("dst").cast(id_type), "weight")
    on = ["src"]
    blocks = F.lit(1)
    if hot:
        arcs, on = salt_rows(arcs, ["src"], hot), ["src", "_salt"]
        # looked up once, by the list that salts the arcs; every step reads it from the ranks
        looked_up = ranks.withColumn("_h", key_hash(["id"])).join(hot_table(spark, hot), "_h", "left")
        before, ranks = ranks, cut(looked_up.withColumn("blocks", F.coalesce("_blocks", F.lit(1))).drop("_h", "_blocks"))
        discard(before)
        blocks = F.col("blocks")
    arcs = arcs.repartition(layout_width(spark, start["links"]), *on).sortWithinPartitions(*on).persist(StorageLevel.MEMORY_AND_DISK)

    for _ in range(max_iterations):
        teleport = (1.0 - damping) + damping * sunk / n
        giving = ranks.where(F.col("gives").isNotNull() & F.col("id").isNotNull()).select(
            F.col("id").alias("src"), (F.col("rank") / F.col("gives")).alias("per_unit"), blocks.alias("blocks")
        )
        if hot:
            giving = giving.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        received = (
            arcs.join(giving, on)
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("weight") * F.col("per_unit")).alias("received"))
        )
        rank = F.lit(teleport) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
        before = ranks
        ranks = cut(
            ranks.join(received, "id", "left").select(
                "id",
                "gives",
                "links",
                *(["blocks"] if hot else []),
                rank.alias("rank"),
                F.abs(rank - F.col("rank")).alias("moved"),
            )
        )
        step = ranks.agg(
            F.max("moved").alias("moved"),
            F.coalesce(F.sum(F.when(F.col("gives").isNull(), F.col("rank"))), F.lit(0.0)).alias("sunk"),
        ).first()
        discard(before)
        sunk = step["sunk"]
        if step["moved"] < tolerance:
            break
    else:
        warnings.warn(f"PageRank still moved after {max_iterations} iterations", stacklevel=2)
    arcs.unpersist()
    return ranks.select(F.col("id").alias("artist"), F.col("rank").alias("authority_score"))


def _of_few(links: DataFrame, nodes: DataFrame, arcs: int, damping: float, tolerance: float, max_iterations: int) -> DataFrame:
    """The same steps for no more nodes than a block has rows: the arcs lie packed where they arrive, the ranks are copied to them."""
    spark, id_type = links.sparkSession, nodes.schema["id"].dataType
    numbered = cut(positions(nodes.select("id", "gives"), [F.asc("id")], "place"))
    giver, taker = (F.broadcast(numbered.select(F.col("id").alias(end), F.col("place").alias(to))) for end, to in (("src", "other"), ("dst", "node")))
    ends = links.select(F.col("src").cast(id_type), F.col("dst").cast(id_type), F.col("weight").cast("double").alias("w"))
    facts = numbered.select("place", "gives").toArrow().sort_by("place")
    ids, gives = facts.column("place").to_numpy(), facts.column("gives").to_numpy().astype(float)  # null is no number
    width = layout_width(spark, arcs)
    blocks = packed.pack(packed.deal(ends.join(giver, "src").join(taker, "dst"), ids, width), len(ids), width)
    sink, rank = np.isnan(gives), np.ones(len(ids))
    for _ in range(max_iterations):
        teleport = (1.0 - damping) + damping * rank[sink].sum() / len(ids)
        before, rank = rank, teleport + damping * packed.received(blocks, np.where(sink, 0.0, rank / gives))
        if np.abs(rank - before).max() < tolerance:
            break
    else:
        warnings.warn(f"PageRank still moved after {max_iterations} iterations", stacklevel=3)
    blocks.unpersist()
    found = F.broadcast(packed.table(spark, {"place": ids, "authority_score": rank}))
    return numbered.select("place", F.col("id").alias("artist")).join(found, "place").select("artist", "authority_score")
