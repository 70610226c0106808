"""The whole analysis in one session: from a catalogue dump to every result table.

Every stage hands its table on as Parquet below `out`. Stages that do not depend on each other run side by side. A stage whose
table is complete and was made from the same inputs is skipped, so an interrupted run picks up where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import (
    clusters,
    community,
    context,
    degree,
    links,
    matching,
    pagerank,
    ranking,
    statistics,
    subgraph,
)
from tributary.operators.aliases import build_alias_map, name_list
from tributary.plans.build import TABLES, build_graph, load_dump
from tributary.plans.stages import Stages, digest
from tributary.session import cut, workspace
from tributary.sources import dumps, sinks

LABEL_NAMES = {
    "node": "artist_name",
    "cluster_id": "cluster_id",
    "representative": "cluster_representative",
}


def run_all(
    spark: SparkSession,
    dump: str,
    out: str,
    alias_path: str | None = None,
    ground_truth: Iterable[str] = matching.GROUND_TRUTH,
    workers: int = 6,
) -> dict[str, str]:
    """Run all stages that are not done yet; returns where each result lies. Tables between steps are deleted at the end.

    A result is computed again if the dump's files, the alias map, the outside list or anything it is made from has changed.
    """
    with workspace(spark):
        return stages_of(spark, dump, out, alias_path, list(ground_truth)).run(workers)


def stages_of(spark: SparkSession, dump: str, out: str, alias_path: str | None, ground_truth: list[str]) -> Stages:
    graph, both, pairs, ranked = "music_graph.parquet", "degrees.parquet", "artist_links.parquet", "artist_pagerank.parquet"
    labelled, flow, hubs, received, matched = (
        "music_labels.parquet", "cluster_flow.parquet", "hubs.parquet", "degree_frequency.parquet", "external_validation.parquet"
    )
    facts = {
        "dump": digest(sinks.listing(spark, *[f"{dump}/{name}" for name in TABLES])),
        "aliases": digest(sinks.listing(spark, alias_path) if alias_path else None), "ground_truth": digest(ground_truth),
    }
    run = Stages(spark, out, facts)
    add = run.add

    def edges() -> DataFrame:
        return links.as_edges(run.table(graph))

    def scores() -> DataFrame:
        return run.table(ranked)

    def labels() -> DataFrame:
        return run.table(labelled).withColumnsRenamed({v: k for k, v in LABEL_NAMES.items()})

    def sampled() -> DataFrame:
        return degree.known(run.table(both), "artist").where("in_degree > 0").select("artist", F.col("in_degree").alias("times_sampled"))

    def using() -> DataFrame:
        return degree.known(run.table(both), "artist").where("out_degree > 0").select("artist", F.col("out_degree").alias("samples_used"))

    def songs() -> DataFrame:
        return run.shared("song facts", lambda: cut(statistics.song_facts(edges())))

    def truth() -> DataFrame:
        return dumps.ranked_names(spark, ground_truth)

    def network(part: int) -> DataFrame:
        return subgraph.top_network(edges(), scores(), labels())[part]

    add(graph, ["dump", "aliases"], lambda: build_graph(load_dump(spark, dump), dumps.read_alias_map(spark, alias_path) if alias_path else None))
    add(both, [graph], lambda: degree.degrees(edges()))
    add(pairs, [graph], lambda: links.collapse(links.drop_self_loops(edges())))
    # what others wait for comes first
    add(labelled, [pairs], lambda: community.louvain(links.undirected(run.table(pairs))).withColumnsRenamed(LABEL_NAMES))
    add(ranked, [pairs], lambda: pagerank.pagerank(run.table(pairs)))
    add(flow, [graph, labelled], lambda: clusters.flow(edges(), labels()))
    add(hubs, [both, ranked, labelled], lambda: degree.hubs_of(run.table(both), scores(), labels()))
    add(matched, [ranked, "ground_truth"], lambda: matching.align(truth(), scores()))
    add(received, [both], lambda: degree.frequency(run.table(both).where("in_degree > 0"), "in_degree"))

    add("in_degree.csv", [both], lambda: _sorted(sampled(), "times_sampled", "artist"))
    add("out_degree.csv", [both], lambda: _sorted(using(), "samples_used", "artist"))
    add("top_100_artists_pagerank.csv", [ranked], lambda: context.top_scored(scores(), 100))
    add("music_cluster_membership.csv", [labelled], lambda: run.table(labelled))
    add("music_clusters.csv", [labelled], lambda: _sizes(clusters.largest(labels(), 100)))

    add("concentration.csv", [both], lambda: degree.concentration_of(run.table(both)))
    add("degree_classes.csv", [both], lambda: _degree_classes(run.table(both)))

    add("cluster_quality_summary.csv", [graph, flow, labelled], lambda: clusters.quality_summary(edges(), labels(), run.table(flow)))
    add("cluster_sizes.csv", [labelled], lambda: _sizes(_sorted(clusters.sizes(labels()), "size", "representative")))
    add("cluster_bridges.csv", [flow, labelled], lambda: clusters.bridges(run.table(flow), labels()))
    add("cluster_density.csv", [flow, labelled], lambda: clusters.densest(run.table(flow), labels()))
    add("top_network_nodes.csv", [graph, ranked, labelled], lambda: network(0))
    add("top_network_links.csv", [graph, ranked, labelled], lambda: network(1))

    add("bridge_artists.csv", [hubs], lambda: degree.top_bridges(run.table(hubs)))
    add("roles.csv", [hubs], lambda: degree.roles(run.table(hubs)))
    add("authority_context.csv", [graph, labelled, ranked], lambda: context.authority_context(edges(), labels(), scores()))
    add("self_loops.csv", [graph, ranked], lambda: degree.self_loop_scores(edges(), scores()))
    add("top_connectivity.csv", [graph, ranked], lambda: context.top_connectivity(edges(), scores()))

    volume = lambda: sampled().where(degree.readable(F.col("artist")))
    add("rank_comparison.csv", [both, ranked], lambda: ranking.compare_ranks(ranking.volume_and_authority(volume(), scores())))
    add("degree_frequency.csv", [received], lambda: _sorted(run.table(received), "degree"))
    add("power_law.csv", [received], lambda: degree.power_law(run.table(received)))
    add("cluster_top_artists.csv", [labelled, ranked], lambda: _sorted(clusters.top_artist(labels(), scores()), "size", "representative"))
    add("cluster_size_histogram.csv", [labelled], lambda: degree.log_histogram(clusters.sizes(labels()), "size"))
    add("external_validation.csv", [matched], lambda: run.table(matched).orderBy("ground_truth_rank"))
    add("external_validation_meta.csv", [matched, "ground_truth"], lambda: matching.agreement_report(truth(), run.table(matched)))

    add("core_network.json", [graph, both, ranked, labelled], lambda: subgraph.core_bundle(edges(), scores(), labels(), run.table(both)), sinks.write_bundle)
    # reports that read all edges come last: what others wait for needs the cores first
    add("artist_aliases.json", [graph], lambda: build_alias_map(name_list(edges(), "src", "dst")), sinks.write_alias_map)
    add("null_counts.csv", [graph], lambda: statistics.long_report(statistics.null_counts(edges())))
    add("top_songs.csv", [graph], lambda: degree.top_songs(edges()))
    add("validation_summary.csv", [graph, both], lambda: statistics.network_summary(edges(), run.table(both), songs()))
    add("statistics_summary.csv", [graph, both], lambda: statistics.overview(edges(), run.table(both), songs()))
    return run


def _sorted(df: DataFrame, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *ties)


def _sizes(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"representative": "cluster_representative", "size": "cluster_size"})


def _degree_classes(both: DataFrame) -> DataFrame:
    rows = [
        degree.class_counts(both, c).withColumn("direction", F.lit(d))
        for d, c in (("in", "in_degree"), ("out", "out_degree"))
    ]
    return rows[0].unionByName(rows[1])
