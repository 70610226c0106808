"""From song-level edges to an artist-level weighted digraph.

Edges carry at least `source_song_id, target_song_id, weight, src, dst`, where
`src` reuses material of `dst`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that stand for no artist.
PLACEHOLDERS = ["[unknown]", "[no artist]"]
UNKNOWN = "[unknown]"


def as_edges(music_graph: DataFrame) -> DataFrame:
    """View the written song graph with the short column names used here."""
    return music_graph.select(
        "source_song_id",
        "target_song_id",
        "weight",
        F.col("Sampler_Artist_Name").alias("src"),
        F.col("Original_Artist_Name").alias("dst"),
        F.col("Sampler_Artist_GID").alias("src_gid"),
        F.col("Original_Artist_GID").alias("dst_gid"),
        F.col("Sampler_Song_Title").alias("src_title"),
        F.col("Original_Song_Title").alias("dst_title"),
    )


def drop_self_loops(edges: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """Keep edges between different ends; rows with a null end go too."""
    return edges.where(F.col(left) != F.col(right))


def drop_placeholders(edges: DataFrame, *columns: str) -> DataFrame:
    """Drop edges whose end carries a placeholder anywhere in its name."""
    pattern = "|".join(p.replace("[", r"\[").replace("]", r"\]") for p in PLACEHOLDERS)
    for c in columns or ("src", "dst"):
        edges = edges.where(~F.col(c).rlike(pattern))
    return edges


def known_names(df: DataFrame, column: str) -> DataFrame:
    """Drop null, empty and placeholder names."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin("", *PLACEHOLDERS))


def collapse(edges: DataFrame) -> DataFrame:
    """One row per ordered pair: links(src, dst, weight)."""
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def collapse_count(edges: DataFrame, at_least: int = 1) -> DataFrame:
    """One row per ordered pair weighted by its number of edges, rare pairs left out."""
    pairs = edges.groupBy("src", "dst").agg(F.count("*").alias("weight"))
    return pairs.where(F.col("weight") >= at_least)


def node_set(links: DataFrame) -> DataFrame:
    """All end points once; both ends leave a single scan."""
    return links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def out_weight(links: DataFrame) -> DataFrame:
    return links.groupBy("src").agg(F.sum("weight").alias("out_wdeg"))


def sinks(links: DataFrame) -> DataFrame:
    """Nodes that reuse nobody: one aggregation over the exploded ends, no anti join."""
    ends = F.explode(
        F.array(
            F.struct(F.col("src").alias("id"), F.lit(True).alias("gives")),
            F.struct(F.col("dst").alias("id"), F.lit(False).alias("gives")),
        )
    )
    gives = links.select(ends.alias("e")).groupBy("e.id").agg(F.max("e.gives").alias("gives"))
    return gives.where(~F.col("gives")).select("id")


def undirected(links: DataFrame) -> DataFrame:
    """Fold A→B and B→A into one row with i < j and the summed weight."""
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    return links.groupBy(low.alias("i"), high.alias("j")).agg(F.sum("weight").alias("w"))


def both_ways(folded: DataFrame) -> DataFrame:
    """Each undirected edge seen from either end: (node, other, w)."""
    ends = F.explode(
        F.array(
            F.struct(F.col("i").alias("node"), F.col("j").alias("other")),
            F.struct(F.col("j").alias("node"), F.col("i").alias("other")),
        )
    )
    return folded.select(ends.alias("e"), "w").select("e.node", "e.other", "w")


def weighted_degree(folded: DataFrame) -> DataFrame:
    """Weighted degree of every node of an undirected graph."""
    ends = F.explode(F.array("i", "j")).alias("node")
    return folded.select(ends, "w").groupBy("node").agg(F.sum("w").alias("wdeg"))


def link_weight(link_type: Column, full: list, known: list) -> Column:
    """Weight of a relation by its type: 1.0 for `full` types, 0.5 for the others known."""
    return F.when(link_type.isin(full), 1.0).when(link_type.isin(known), 0.5)
