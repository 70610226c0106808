"""Size, density, reciprocity and data quality of the edge table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scales import ratio
from tributary.operators.degree import concentration_active, degrees


def long_report(*rows: DataFrame) -> DataFrame:
    """Turn one-row tables into (metric, value) rows."""
    parts = [
        row.select([F.col(c).cast("double").alias(c) for c in row.columns]).unpivot(
            [], row.columns, "metric", "value"
        )
        for row in rows
    ]
    return reduce(DataFrame.unionByName, parts)


def null_counts(edges: DataFrame) -> DataFrame:
    """One row: nulls in either song and either artist."""
    names = {
        "source_song_id": "null_source",
        "target_song_id": "null_target",
        "src": "null_sampler",
        "dst": "null_original",
    }
    return edges.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in names.items()])


def duplicate_groups(edges: DataFrame) -> DataFrame:
    """One row: song pairs that occur more than once."""
    pairs = edges.groupBy("source_song_id", "target_song_id").agg(F.count("*").alias("n"))
    return pairs.agg(F.count_if(F.col("n") > 1).alias("duplicate_edges"))


def song_self_loops(edges: DataFrame) -> DataFrame:
    same = F.col("source_song_id") == F.col("target_song_id")
    return edges.agg(F.count_if(same).alias("self_loops"))


def reciprocity(edges: DataFrame) -> DataFrame:
    """One row: ordered pairs, those whose reverse exists too, and their share.

    Both directions of a pair meet in one group, so no self-join is needed. An
    artist paired with itself is its own reverse.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    pairs = edges.groupBy(low.alias("a"), high.alias("b")).agg(
        F.max((F.col("src") <= F.col("dst")).cast("int")).alias("up"),
        F.max((F.col("src") > F.col("dst")).cast("int")).alias("down"),
    )
    both = F.col("up") + F.col("down")
    mutual = F.when(F.col("a") == F.col("b"), 1).when(both == 2, 2).otherwise(0)
    counted = pairs.agg(
        F.coalesce(F.sum(mutual), F.lit(0)).alias("reciprocal_edge_pairs"),
        F.coalesce(F.sum(both), F.lit(0)).alias("total_directed_pairs"),
    )
    share = ratio(F.col("reciprocal_edge_pairs"), F.col("total_directed_pairs"))
    return counted.withColumn("reciprocity", share)


def beside(row: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row tables as one row."""
    held = row.withColumn("_other", other.select(F.struct("*")).scalar())
    return held.select(*row.columns, "_other.*")


def song_facts(edges: DataFrame) -> DataFrame:
    """One row: total_songs, self_loops, duplicate_edges.

    Songs and song pairs are counted in one grouping of one scan: an edge is one
    pair and two songs, and equal ones are merged before they move.
    """
    none = F.lit(None).cast(edges.schema["target_song_id"].dataType)
    kinds = F.explode(
        F.array(
            F.struct(F.lit(True).alias("pair"), F.col("source_song_id").alias("a"), F.col("target_song_id").alias("b")),
            F.struct(F.lit(False).alias("pair"), F.col("source_song_id").alias("a"), none.alias("b")),
            F.struct(F.lit(False).alias("pair"), F.col("target_song_id").alias("a"), none.alias("b")),
        )
    )
    counted = edges.select(kinds.alias("k")).groupBy("k.pair", "k.a", "k.b").agg(F.count("*").alias("n"))
    pair = F.col("pair")
    return counted.agg(
        F.count_if(~pair).alias("total_songs"),
        F.coalesce(F.sum(F.when(pair & (F.col("a") == F.col("b")), F.col("n"))), F.lit(0)).alias("self_loops"),
        F.count_if(pair & (F.col("n") > 1)).alias("duplicate_edges"),
    )


def artist_facts(both: DataFrame) -> DataFrame:
    """One row of degrees(artist, in_degree, out_degree): artists by role, and mean, deviation and
    maximum of both degrees over the artists that have any."""
    into = F.when(F.col("in_degree") > 0, F.col("in_degree"))
    out = F.when(F.col("out_degree") > 0, F.col("out_degree"))
    return both.agg(
        F.sum("in_degree").alias("total_edges"),
        F.count("*").alias("total_artists"),
        F.count(out).alias("samplers"),
        F.count(into).alias("originals"),
        F.avg(into).alias("in_degree_mean"),
        F.stddev_samp(into).alias("in_degree_stddev"),
        F.max(into).alias("in_degree_max"),
        F.avg(out).alias("out_degree_mean"),
        F.stddev_samp(out).alias("out_degree_stddev"),
        F.max(out).alias("out_degree_max"),
    )


SPREADS = [f"{side}_degree_{what}" for side in ("in", "out") for what in ("mean", "stddev", "max")]


def graph_facts(both: DataFrame, edges: DataFrame, songs: DataFrame | None = None) -> DataFrame:
    """One row: artist_facts and song_facts, edges per artist and density over songs; `songs` are the song_facts if they are known already."""
    facts = beside(artist_facts(both), song_facts(edges) if songs is None else songs)
    e, s = F.col("total_edges").cast("double"), F.col("total_songs").cast("double")
    return facts.withColumns({
        "avg_edges_per_artist": ratio(e, F.col("total_artists")),
        "graph_density": ratio(e, s * (s - 1)),
    })


def node_counts(edges: DataFrame) -> DataFrame:
    """One row: edges, artists by role, songs, edges per artist and density over songs."""
    return graph_facts(degrees(edges), edges).select(
        "total_edges", "total_songs", "total_artists", "samplers", "originals", "avg_edges_per_artist", "graph_density"
    )


def degree_spreads(edges: DataFrame) -> DataFrame:
    """One row: mean, deviation and maximum of both degrees over the artists that have any."""
    return artist_facts(degrees(edges)).select(SPREADS)


def overview(edges: DataFrame, both: DataFrame | None = None, songs: DataFrame | None = None) -> DataFrame:
    """The long (metric, value) summary of structure, degrees and concentration."""
    facts = graph_facts(degrees(edges) if both is None else both, edges, songs)
    counts = ["total_edges", "total_songs", "total_artists", "samplers", "originals", "graph_density"]
    return long_report(beside(facts.select(*counts, *SPREADS), concentration_active(edges)))


def network_summary(edges: DataFrame, both: DataFrame | None = None, songs: DataFrame | None = None) -> DataFrame:
    """The long (metric, value) report on the whole graph."""
    facts = graph_facts(degrees(edges) if both is None else both, edges, songs)
    counts = ["total_edges", "total_songs", "total_artists", "avg_edges_per_artist", "graph_density"]
    wanted = facts.select(*counts, *SPREADS, "self_loops", "duplicate_edges")
    return long_report(beside(wanted, reciprocity(edges)))
