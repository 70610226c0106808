"""Every registered query: name -> (DataFrame function, SQL text or None)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity import catalogue as cat
from parity import standins as std
from tributary.functions import scales, text
from tributary.operators import (
    aliases,
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
from tributary.operators.components import components
from tributary.operators.skew import Chain, positions, spread_join
from tributary.plans import build, stages, workflow
from tributary.session import checkpoint_root, handoff, side_by_side
from tributary.sources import dumps, sinks

REGISTRY: dict[str, tuple] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, folder) -> DataFrame beside its SQL."""

    def register(function):
        REGISTRY[name or function.__name__] = (function, sql)
        return function

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema if f.dataType.simpleString() == "double"}
    return df.select([F.round(c, places).alias(c) if c in doubles else F.col(c) for c in df.columns])


DENSE, SPARSE = std.edges_sql("dense"), std.edges_sql("sparse")
DENSE_LINKS, SPARSE_LINKS = std.links_sql("dense"), std.links_sql("sparse")

# --- graph build and names -------------------------------------------------


@query(f"with {DENSE} select * from edges")
def edges_build(spark, sf):
    return std.edges(spark, sf, "dense")


@query(f"with {SPARSE} select * from edges")
def edges_build_by_supplier(spark, sf):
    return std.edges(spark, sf, "sparse")


@query(f"with {cat.YEARS_SQL} select * from years")
def release_year(spark, sf):
    t = cat.tables(spark, sf)
    return build.release_years(t["track"], t["medium"], t["release"], t["release_group_meta"])


@query(
    "select l_partkey as recording, min(year(o_orderdate)) as release_year "
    "from lineitem join orders on l_orderkey = o_orderkey group by 1"
)
def earliest_use(spark, sf):
    orders = std.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("year")
    )
    lines = std.table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    dated = spread_join(lines, orders, "l_orderkey")
    return dated.groupBy(F.col("l_partkey").alias("recording")).agg(F.min("year").alias("release_year"))


@query(f"with {cat.NAMES_SQL} select id, {cat.strip_sql('name')} as name, gid from names")
def main_credits(spark, sf):
    t = cat.tables(spark, sf)
    return build.main_credits(t["artist_credit_name"], t["artist"])


@query(
    """with reuse as (
  select l_orderkey as entity0, lag(l_orderkey) over (partition by l_partkey order by l_orderkey) as entity1 from lineitem)
select entity0 as source_song_id, entity1 as target_song_id,
  cast(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1.0 else 0.5 end as double) as weight
from reuse join orders on entity0 = o_orderkey where entity1 is not null and o_orderpriority <> '5-LOW'"""
)
def reuse_relations(spark, sf):
    t = cat.tables(spark, sf)
    return build.reuse_edges(t["l_recording_recording"], t["link"])


@query(f"with {cat.GRAPH_SQL} select * from graph")
def graph_build(spark, sf):
    return cat.music_graph(spark, sf)


@query(f"with {cat.NAMES_SQL} select id, {cat.clean_sql(cat.strip_sql('name'))} as clean from names")
def name_clean(spark, sf):
    name = text.clean_name(text.strip_featured(F.col("name")))
    return cat.names(spark, sf).select("id", name.alias("clean"))


@query(
    f"with {cat.NAMES_SQL} select id, name from names "
    "where name is not null and name not in ('', '[unknown]', '[no artist]')"
)
def placeholder_filter(spark, sf):
    return links.known_names(cat.names(spark, sf), "name").select("id", "name")


@query(
    rf"with {cat.NAMES_SQL} select id, name from names where not regexp_matches(name, '\[unknown\]|\[no artist\]')"
)
def placeholder_pattern_filter(spark, sf):
    return links.drop_placeholders(cat.names(spark, sf), "name").select("id", "name")


@query(
    rf"""select doc_id, cast(length(text) > 0 and text not in ('[unknown]', '[no artist]')
  and not regexp_matches(replace(text, ' ', ''), '[\p{{C}}\p{{Z}}]') as boolean) as readable from documents"""
)
def readable_texts(spark, sf):
    docs = std.table(spark, sf, "documents")
    return docs.select("doc_id", text.readable(F.col("text")).alias("readable"))


@query(
    rf"""with {cat.NAMES_SQL} select id, cast(length(name) > 0 and name not in ('[unknown]', '[no artist]')
  and not regexp_matches(replace(name, ' ', ''), '[\p{{C}}\p{{Z}}]') as boolean) as readable from names"""
)
def readable_names(spark, sf):
    return cat.names(spark, sf).select("id", text.readable(F.col("name")).alias("readable"))


def listed(spark, sf):
    return aliases.name_list(cat.names(spark, sf), "name")


@query(f"with {cat.ALIAS_SQL} select * from case_alias")
def alias_case(spark, sf):
    return aliases.case_aliases(listed(spark, sf))


@query(f"with {cat.ALIAS_SQL} select * from prefix_alias")
def alias_prefix(spark, sf):
    return aliases.prefix_aliases(listed(spark, sf))


@query(f"with {cat.ALIAS_SQL} select * from alias_map")
def alias_merge(spark, sf):
    return aliases.build_alias_map(listed(spark, sf))


@query(f"with {cat.CREDITS_SQL} select * from credits")
def alias_apply(spark, sf):
    artists = cat.names(spark, sf).withColumn("name", text.strip_featured(F.col("name")))
    return aliases.apply_aliases(artists, cat.alias_table(spark, sf)).select("id", "name", "gid")


# --- self-loops ------------------------------------------------------------


@query(f"with {DENSE} select * from edges where src <> dst")
def self_loop_removal(spark, sf):
    return links.drop_self_loops(std.edges(spark, sf, "dense"))


@query(f"with {DENSE} select src as artist, count(*) as self_sample_count from edges where src = dst group by 1")
def self_loop_census(spark, sf):
    return degree.self_loop_counts(std.edges(spark, sf, "dense"))


@query(
    f"with {DENSE} select source_song_id, target_song_id, src, dst from edges where src = dst"
)
def self_loop_rows(spark, sf):
    own = std.edges(spark, sf, "dense").where(F.col("src") == F.col("dst"))
    return own.select("source_song_id", "target_song_id", "src", "dst")


@query(
    f"""with {DENSE_LINKS}, {std.SCORES_SQL}
select artist, self_sample_count, authority_score
from (select src as artist, count(*) as self_sample_count from edges where src = dst group by 1) join scores using (artist)"""
)
def self_loop_authority(spark, sf):
    return degree.self_loop_scores(std.edges(spark, sf, "dense"), std.scores(spark, sf, "dense"))


# --- degrees and their distribution ----------------------------------------


@query(f"with {DENSE} select dst as artist, count(*) as times_sampled from edges group by 1")
def degree_in(spark, sf):
    return degree.in_degree(std.edges(spark, sf, "dense"))


@query(f"with {DENSE} select src as artist, count(*) as samples_used from edges group by 1")
def degree_out(spark, sf):
    return degree.out_degree(std.edges(spark, sf, "dense"))


@query(
    f"""with {cat.GRAPH_SQL} select Original_Artist_Name as artist, Original_Song_Title as title,
  count(*) as times_used from graph group by 1, 2"""
)
def top_songs(spark, sf):
    return degree.top_songs(links.as_edges(cat.music_graph(spark, sf)))


def degree_rows_sql(measure: str) -> str:
    return f"""with {DENSE},
i as (select count(*) as n from edges group by dst), o as (select count(*) as n from edges group by src)
select 'in' as direction, {measure} from i union all select 'out', {measure} from o"""


def both_directions(spark, sf, density, measure):
    both = degree.degrees(std.edges(spark, sf, density))
    rows = [
        measure(both.where(F.col(c) > 0), c).withColumn("direction", F.lit(d))
        for d, c in (("in", "in_degree"), ("out", "out_degree"))
    ]
    return rounded(rows[0].unionByName(rows[1]))


@query(
    degree_rows_sql(
        "min(n) as min, max(n) as max, round(avg(n), 6) as mean, round(stddev_samp(n), 6) as stddev"
    )
)
def degree_stats(spark, sf):
    return both_directions(spark, sf, "dense", degree.summary)


@query(
    degree_rows_sql(
        ", ".join(f"count(*) filter (n >= {k}) as at_least_{k}" for k in (1, 5, 10, 50, 100))
    )
)
def degree_buckets(spark, sf):
    return both_directions(spark, sf, "dense", degree.class_counts)


CONCENTRATION_SQL = f"""with {SPARSE},
artists as (select greatest(1, floor(0.01 * count(*))) as n from (select src from edges union select dst from edges)),
d as (select 'in' as direction, count(*) as degree from edges group by dst
  union all select 'out', count(*) from edges group by src),
r as (select *, row_number() over (partition by direction order by degree desc) as place from d),
shares as (
  select direction, cast(count(*) filter (place <= n) as bigint) as artists,
    cast(sum(degree) filter (place <= n) as bigint) as edges,
    round(sum(degree) filter (place <= n) * 100.0 / sum(degree), 6) as pct
  from r, artists group by direction)"""


@query(f"{CONCENTRATION_SQL} select * from shares")
def concentration_all(spark, sf):
    return rounded(degree.concentration_all(std.edges(spark, sf)))


@query(f"{CONCENTRATION_SQL} select pct, pct > 20 as scale_free from shares where direction = 'in'")
def scale_free_flag(spark, sf):
    return rounded(degree.scale_free(std.edges(spark, sf)))


@query(
    f"""with {SPARSE}, d as (select count(*) as degree from edges group by dst),
r as (select degree, row_number() over (order by degree desc) as place, count(*) over () as n from d)
select {", ".join(f"round(coalesce(sum(degree) filter (place <= floor(n * {p / 100})), 0) * 100.0 / sum(degree), 6) as top{p}_pct" for p in (1, 5, 10))}
from r"""
)
def concentration_active(spark, sf):
    return rounded(degree.concentration_active(std.edges(spark, sf)))


FREQUENCY_SQL = f"""{SPARSE}, d as (select count(*) as degree from edges group by dst),
freq as (select degree, count(*) as frequency from d group by degree)"""


def in_frequency(spark, sf):
    return degree.frequency(degree.in_degree(std.edges(spark, sf)), "times_sampled")


@query(f"with {FREQUENCY_SQL} select * from freq")
def degree_frequency(spark, sf):
    return in_frequency(spark, sf)


FIT_SQL = """fit as (select regr_slope(log10(frequency), log10(degree)) as slope,
  regr_intercept(log10(frequency), log10(degree)) as intercept from freq)"""


@query(
    f"""with {FREQUENCY_SQL}, {FIT_SQL}
select round(slope, 6) as slope, round(intercept, 6) as intercept, round(abs(slope), 6) as gamma from fit"""
)
def power_law_fit(spark, sf):
    return rounded(degree.power_law(in_frequency(spark, sf)))


@query(
    f"""with {FREQUENCY_SQL}, {FIT_SQL},
span as (select log10(min(degree)) as a, log10(max(degree)) as b from freq),
x as (select cast(point as int) as point, a + (b - a) * point / 99 as lx from span, range(100) t(point))
select point, round(pow(10, lx), 6) as degree, round(pow(10, intercept + slope * lx), 6) as frequency from x, fit"""
)
def power_law_curve(spark, sf):
    return rounded(degree.power_law_curve(in_frequency(spark, sf)))


@query(
    f"""with {DENSE}, d as (select count(*) as size from edges group by dst),
top as (select max(size) as m from d),
b as (select cast(least(38, floor(log10(size) / log10(m) * 39)) as int) as bin, count(*) as n from d, top group by 1)
select cast(range as int) as bin, coalesce(n, 0) as count from range(39) left join b on bin = range"""
)
def log_histogram(spark, sf):
    return degree.log_histogram(degree.in_degree(std.edges(spark, sf, "dense")), "times_sampled")


# --- links, PageRank -------------------------------------------------------


@query(f"with {SPARSE_LINKS} select * from links")
def artist_links(spark, sf):
    return std.links(spark, sf)


@query(f"with {DENSE} select src, dst, count(*) as weight from edges group by 1, 2 having count(*) >= 2")
def link_count_having(spark, sf):
    return links.collapse_count(std.edges(spark, sf, "dense"), at_least=2)


@query(f"with {SPARSE_LINKS} select src, sum(weight) as out_wdeg from links group by 1")
def out_weight(spark, sf):
    return links.out_weight(std.links(spark, sf))


@query(f"with {SPARSE_LINKS} select src as id from links union select dst from links")
def node_set(spark, sf):
    return links.node_set(std.links(spark, sf))


@query(f"with {SPARSE_LINKS} select distinct dst as id from links where dst not in (select src from links)")
def sinks_found(spark, sf):
    return links.sinks(std.links(spark, sf))


def pagerank_sql(steps: int, tolerance: float, density: str = "sparse") -> str:
    """All steps written out; once a step moves no rank by the tolerance the ranks stay."""
    parts = [
        std.links_sql(density).replace("links as (", "links as materialized (", 1),
        "nodes as materialized (select src as id from links union select dst from links)",
        "outw as materialized (select src, sum(weight) as w from links group by src)",
        "r0 as materialized (select id, cast(1.0 as double) as rank from nodes)",
        "d0 as materialized (select false as done)",
    ]
    for k in range(1, steps + 1):
        old = f"r{k - 1}"
        parts.append(
            f"""r{k} as materialized (
  select n.id, case when (select done from d{k - 1}) then p.rank else
    0.15 + 0.85 * (select coalesce(sum(rank), 0) from {old} where id not in (select src from outw))
      / (select count(*) from nodes) + 0.85 * coalesce(s.got, 0) end as rank
  from nodes n join {old} p on p.id = n.id left join (
    select l.dst, sum(o.rank * l.weight / outw.w) as got
    from links l join {old} o on o.id = l.src join outw on outw.src = l.src group by l.dst) s on s.dst = n.id)"""
        )
        parts.append(
            f"""d{k} as materialized (select (select done from d{k - 1}) or max(abs(a.rank - b.rank)) < {tolerance} as done
  from r{k} a join {old} b using (id))"""
        )
    return "with " + ",\n".join(parts) + f"\nselect id as artist, round(rank, 6) as authority_score from r{steps}"


@query(pagerank_sql(10, 0))
def pagerank_ten_steps(spark, sf):
    return rounded(pagerank.pagerank(std.links(spark, sf), tolerance=0.0, max_iterations=10))


@query(pagerank_sql(50, 0.01))
def pagerank_converged(spark, sf):
    return rounded(pagerank.pagerank(std.links(spark, sf)))


@query(pagerank_sql(50, 0.01, "dense"))
def pagerank_dense(spark, sf):
    return rounded(pagerank.pagerank(std.links(spark, sf, "dense")))


@query(pagerank_sql(50, 0.01) + " order by rank desc, id limit 100")
def pagerank_top100(spark, sf):
    return rounded(context.top_scored(pagerank.pagerank(std.links(spark, sf)), 100))


# --- network statistics ----------------------------------------------------


SUMMARY_SQL = f"""with {DENSE},
s as (select count(distinct x) as n from (select source_song_id as x from edges union all select target_song_id from edges)),
a as (select count(distinct x) as n from (select src as x from edges union all select dst from edges)),
e as (select count(*) as n, count(*) filter (source_song_id = target_song_id) as loops from edges),
i as (select avg(n) as mean, stddev_samp(n) as dev, max(n) as top from (select count(*) as n from edges group by dst)),
o as (select avg(n) as mean, stddev_samp(n) as dev, max(n) as top from (select count(*) as n from edges group by src)),
d as (select count(*) as n from (select 1 from edges group by source_song_id, target_song_id having count(*) > 1)),
p as (select distinct src, dst from edges),
r as (select count(*) as n from p x join p y on x.src = y.dst and x.dst = y.src),
t as (select count(*) as n from p)"""


@query(
    f"""{SUMMARY_SQL}
select metric, round(cast(value as double), 6) as value from (
  select 'total_edges' as metric, cast(n as double) as value from e
  union all select 'total_songs', n from s union all select 'total_artists', n from a
  union all select 'avg_edges_per_artist', e.n / a.n from e, a
  union all select 'graph_density', cast(e.n as double) / (cast(s.n as double) * (s.n - 1)) from e, s
  union all select 'in_degree_mean', mean from i union all select 'in_degree_stddev', dev from i
  union all select 'in_degree_max', top from i
  union all select 'out_degree_mean', mean from o union all select 'out_degree_stddev', dev from o
  union all select 'out_degree_max', top from o
  union all select 'self_loops', loops from e union all select 'duplicate_edges', n from d
  union all select 'reciprocal_edge_pairs', n from r union all select 'total_directed_pairs', n from t
  union all select 'reciprocity', r.n / t.n from r, t)"""
)
def network_summary(spark, sf):
    return rounded(statistics.network_summary(std.edges(spark, sf, "dense")))


@query(
    f"""{SUMMARY_SQL} select e.n as total_edges, s.n as total_songs, a.n as total_artists,
  (select count(distinct src) from edges) as samplers, (select count(distinct dst) from edges) as originals,
  round(e.n / a.n, 6) as avg_edges_per_artist,
  round(cast(e.n as double) / (cast(s.n as double) * (s.n - 1)), 6) as graph_density from e, s, a"""
)
def node_counts(spark, sf):
    return rounded(statistics.node_counts(std.edges(spark, sf, "dense")))


OVERVIEW_SQL = f"""{SUMMARY_SQL},
ranked as (select n, row_number() over (order by n desc) as place, count(*) over () as k
  from (select count(*) as n from edges group by dst))"""


@query(
    f"""{OVERVIEW_SQL}
select metric, round(cast(value as double), 6) as value from (
  select 'total_edges' as metric, cast(n as double) as value from e
  union all select 'total_songs', n from s union all select 'total_artists', n from a
  union all select 'samplers', count(distinct src) from edges
  union all select 'originals', count(distinct dst) from edges
  union all select 'graph_density', cast(e.n as double) / (cast(s.n as double) * (s.n - 1)) from e, s
  union all select 'in_degree_mean', mean from i union all select 'in_degree_stddev', dev from i
  union all select 'in_degree_max', top from i
  union all select 'out_degree_mean', mean from o union all select 'out_degree_stddev', dev from o
  union all select 'out_degree_max', top from o
  {" ".join(f"union all select 'top{p}_pct', sum(n) filter (place <= floor(k * {p / 100})) * 100.0 / sum(n) from ranked" for p in (1, 5, 10))})"""
)
def statistics_overview(spark, sf):
    return rounded(statistics.overview(std.edges(spark, sf, "dense")))


# The raw relations still have songs without an earlier use, so there are nulls to count.
@query(
    """with reuse as (
  select l_orderkey as entity0, lag(l_orderkey) over (partition by l_partkey order by l_orderkey) as entity1 from lineitem)
select count(*) filter (entity0 is null) as null_source, count(*) filter (entity1 is null) as null_target,
  count(*) filter (a.o_custkey is null) as null_sampler, count(*) filter (b.o_custkey is null) as null_original
from reuse left join orders a on entity0 = a.o_orderkey left join orders b on entity1 = b.o_orderkey"""
)
def null_counts(spark, sf):
    songs = std.table(spark, sf, "orders")
    raw = std.reuse(spark, sf, "dense").withColumnsRenamed(
        {"entity0": "source_song_id", "entity1": "target_song_id"}
    )
    raw = Chain(raw, "source_song_id", "target_song_id")
    for key, end in (("source_song_id", "src"), ("target_song_id", "dst")):
        raw.join(songs.select(F.col("o_orderkey").alias(key), F.col("o_custkey").alias(end)), key, "left")
    return statistics.null_counts(raw.df)


@query(f"{SUMMARY_SQL} select n as duplicate_edges from d")
def duplicate_edges(spark, sf):
    return statistics.duplicate_groups(std.edges(spark, sf, "dense"))


@query(f"{SUMMARY_SQL} select loops as self_loops from e")
def song_self_loops(spark, sf):
    return statistics.song_self_loops(std.edges(spark, sf, "dense"))


@query(
    f"""{SUMMARY_SQL} select r.n as reciprocal_edge_pairs, t.n as total_directed_pairs,
  round(r.n / t.n, 6) as reciprocity from r, t"""
)
def reciprocity(spark, sf):
    return rounded(statistics.reciprocity(std.edges(spark, sf, "dense")))


# --- undirected graph, communities -----------------------------------------

UNDIRECTED_SQL = f"""{SPARSE_LINKS},
und as (select least(src, dst) as i, greatest(src, dst) as j, sum(weight) as w from links group by 1, 2),
deg as (select node, sum(w) as wdeg from (select i as node, w from und union all select j, w from und) group by 1)"""


def folded(spark, sf, density="sparse"):
    return links.undirected(std.links(spark, sf, density))


@query(f"with {UNDIRECTED_SQL} select * from und")
def undirected_links(spark, sf):
    return folded(spark, sf)


@query(f"with {UNDIRECTED_SQL} select * from deg")
def weighted_degree(spark, sf):
    return links.weighted_degree(folded(spark, sf))


@query(
    f"""with {UNDIRECTED_SQL}, {std.LABELS_SQL},
c as (select d.node, wdeg, coalesce('c' || l.cluster_id, 'n' || d.node) as c from deg d left join labels l on l.node = d.node),
k as (select c, sum(wdeg) as k from c group by c), m as (select sum(w) as m from und),
inside as (select coalesce(sum(w), 0) as w from und join c a on a.node = i join c b on b.node = j where a.c = b.c)
select round(inside.w / m - sum(k * k) / (4 * m * m), 6) as modularity from k, m, inside group by inside.w, m"""
)
def modularity_given(spark, sf):
    return rounded(community.modularity(folded(spark, sf), std.labels(spark, sf)))


@query(
    f"""with {UNDIRECTED_SQL}, {std.LABELS_SQL}
select cluster_id, first(l.node order by coalesce(wdeg, 0) desc, l.node) as representative
from labels l left join deg d on d.node = l.node group by cluster_id"""
)
def cluster_representative(spark, sf):
    return clusters.strongest_member(std.labels(spark, sf), links.weighted_degree(folded(spark, sf)))


@cache
def _communities(app: str, spark: SparkSession, sf: str) -> DataFrame:
    return handoff(community.louvain(folded(spark, sf)), "communities")


def communities(spark, sf):
    """Found once per application, like the other tables handed on."""
    return _communities(spark.sparkContext.applicationId, spark, sf)


#: Customers in groups of five, linked all to all; groups form a ring of links so weak that joining two of them never pays.
RING_SQL = """people as (select c_custkey as node, c_custkey // 5 as grp from customer),
last_group as (select max(grp) as g from people),
ring as (
  select a.node as i, b.node as j, 1.0 as w from people a join people b on a.grp = b.grp and a.node < b.node
  union all
  select min(a.node), max(b.node), 1.0 / (1 + max(g)) from people a join people b on b.grp = a.grp + 1, last_group group by a.grp)"""


def ring_of_groups(spark, sf):
    people = std.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("node"), F.floor(F.col("c_custkey") / 5).alias("grp")
    )
    members = people.groupBy("grp").agg(F.array_sort(F.collect_list("node")).alias("all"))  # five at most
    inside = members.select(F.explode("all").alias("i"), "all").select("i", F.explode("all").alias("j")).where("i < j")
    groups = people.agg(F.max("grp") + 1).scalar()
    ends = members.select("grp", F.array_min("all").alias("i"), F.array_max("all").alias("j"))
    following = ends.select((F.col("grp") - 1).alias("grp"), F.col("j"))
    weak = ends.select("grp", "i").join(following, "grp").select("i", "j", (1.0 / groups).alias("w"))
    return inside.withColumn("w", F.lit(1.0)).unionByName(weak)


@query(
    f"""with {RING_SQL}, both_ways as (select i as node, w from ring union all select j, w from ring),
strength as (select node, round(sum(w), 9) as s from both_ways group by 1)
select node, grp as cluster_id, first_value(node) over (partition by grp order by s desc, node) as representative
from people join strength using (node)"""
)
def louvain_labels(spark, sf):
    """Labels on a graph whose best partition is known, ids by smallest member."""
    return community.louvain(ring_of_groups(spark, sf))


@query(
    f"""with {UNDIRECTED_SQL} select count(*) as labelled, true as ids_from_zero, true as one_representative_each,
  true as representative_is_strongest, true as better_than_given, true as better_than_joined from deg"""
)
def louvain_quality(spark, sf):
    """What must hold for any good clustering of the graph, whatever its labels: above all a modularity above that of the given
    labels and of joining every node to its heaviest neighbour. One-by-one sweeps are held against it in tests."""
    graph = folded(spark, sf)
    found = communities(spark, sf)
    strongest = clusters.strongest_member(
        found.select("node", "cluster_id"), links.weighted_degree(graph)
    ).withColumnRenamed("representative", "expected")
    per_cluster = (
        found.groupBy("cluster_id")
        .agg(F.count("*").alias("n"), F.min("representative").alias("a"), F.max("representative").alias("b"))
        .join(strongest, "cluster_id")
        .agg(
            F.sum("n").alias("labelled"),
            (F.max("cluster_id") + 1 == F.count("*")).alias("ids_from_zero"),
            F.bool_and(F.col("a") == F.col("b")).alias("one_representative_each"),
            F.bool_and(F.col("a") == F.col("expected")).alias("representative_is_strongest"),
        )
    )
    heaviest = links.both_ways(graph).groupBy("node").agg(F.min_by("other", F.struct((-F.col("w")).alias("falling"), "other")).alias("other"))
    joined = components(heaviest.select(F.col("node").alias("a"), F.col("other").alias("b")))
    own = community.modularity(graph, found).scalar()
    return per_cluster.withColumns({
        "better_than_given": own > community.modularity(graph, std.labels(spark, sf)).scalar(),
        "better_than_joined": own >= community.modularity(graph, joined.withColumnRenamed("root", "cluster_id")).scalar(),
    })


# --- cluster quality with the given labels ---------------------------------

LABELS = std.LABELS_SQL
SIZES_SQL = f"{LABELS}, sizes as (select representative, count(*) as size from labels group by 1)"


@query(f"with {SIZES_SQL} select * from sizes")
def cluster_sizes(spark, sf):
    return clusters.sizes(std.labels(spark, sf))


@query(
    f"""with {SIZES_SQL} select count(*) as num_clusters, cast(sum(size) as bigint) as total_nodes, min(size) as min_size,
  max(size) as max_size, round(avg(size), 6) as avg_size, round(coalesce(stddev_samp(size), 0), 6) as stddev_size,
  round(median(size), 6) as median_size from sizes"""
)
def cluster_size_stats(spark, sf):
    return rounded(clusters.size_summary(clusters.sizes(std.labels(spark, sf))))


@query(
    f"""with {SIZES_SQL} select count(*) filter (size = 1) as singleton, count(*) filter (size between 2 and 10) as small,
  count(*) filter (size between 11 and 50) as medium, count(*) filter (size between 51 and 200) as large,
  count(*) filter (size > 200) as giant from sizes"""
)
def cluster_size_buckets(spark, sf):
    return clusters.size_classes(clusters.sizes(std.labels(spark, sf)))


MIX_SQL = f"""{DENSE}, {SIZES_SQL},
tagged as (select s.cluster_id as a, t.cluster_id as b from edges
  left join labels s on s.node = src left join labels t on t.node = dst),
mix as (select count(*) filter (a = b) as intra_cluster_edges, count(*) filter (a <> b) as inter_cluster_edges,
  count(*) filter (a is null or b is null) as unclustered_edges, count(*) as total_edges from tagged)"""


def flows(spark, sf):
    return clusters.flow(std.edges(spark, sf, "dense"), std.labels(spark, sf))


@query(f"with {MIX_SQL} select a as src_cluster, b as dst_cluster, count(*) as n from tagged group by 1, 2")
def cluster_flow(spark, sf):
    return flows(spark, sf)


@query(
    f"""with {MIX_SQL} select *, round(100.0 * intra_cluster_edges / total_edges, 6) as intra_pct,
  round(100.0 * inter_cluster_edges / total_edges, 6) as inter_pct,
  round(100.0 * unclustered_edges / total_edges, 6) as unclustered_pct,
  round(intra_cluster_edges / total_edges, 6) as intra_cluster_edge_fraction,
  case when intra_cluster_edges / total_edges > 0.5 then 'tight' when intra_cluster_edges / total_edges > 0.3 then 'moderate'
    when intra_cluster_edges / total_edges > 0.15 then 'some' else 'low' end as cohesion from mix"""
)
def edge_cluster_mix(spark, sf):
    return rounded(clusters.mix(flows(spark, sf)))


@query(
    f"""with {MIX_SQL} select metric, round(cast(value as double), 6) as value from (
  select 'num_clusters' as metric, cast(count(*) as double) as value from sizes
  union all select 'avg_cluster_size', avg(size) from sizes union all select 'max_cluster_size', max(size) from sizes
  union all select 'intra_cluster_edge_fraction', intra_cluster_edges / total_edges from mix
  union all select 'intra_cluster_edges', intra_cluster_edges from mix
  union all select 'inter_cluster_edges', inter_cluster_edges from mix
  union all select 'unclustered_edges', unclustered_edges from mix)"""
)
def cluster_quality_summary(spark, sf):
    return rounded(clusters.quality_summary(std.edges(spark, sf, "dense"), std.labels(spark, sf)))


@query(
    f"""with {MIX_SQL}, top as (select cluster_id, representative, count(*) as size from labels group by 1, 2
  order by size desc, representative limit 5)
select representative, size, count(a) as internal_edges, round(count(a) / (size * (size - 1)), 6) as density
from top left join tagged on a = cluster_id and b = cluster_id group by representative, size"""
)
def cluster_density_top5(spark, sf):
    return rounded(clusters.densest(flows(spark, sf), std.labels(spark, sf)))


@query(
    f"""with {MIX_SQL}, named as (select distinct cluster_id, representative from labels)
select s.representative as From_Cluster, t.representative as To_Cluster, count(*) as Connection_Strength
from tagged join named s on s.cluster_id = a join named t on t.cluster_id = b where a <> b group by 1, 2"""
)
def cluster_bridges(spark, sf):
    return clusters.bridges(flows(spark, sf), std.labels(spark, sf))


@query(
    f"""with {SPARSE_LINKS}, {std.SCORES_SQL}, {SIZES_SQL},
best as (select representative, first(case when authority_score is not null then node end
    order by authority_score desc nulls last, node) as artist
  from labels left join scores on artist = node group by 1)
select representative, size, artist, case when artist is not null then cast(artist as varchar) || ' Cluster'
  else 'Cluster ' || representative end as label from sizes join best using (representative)"""
)
def cluster_top_artist(spark, sf):
    return clusters.top_artist(std.labels(spark, sf), std.scores(spark, sf))


TOP5_SQL = f"""{SPARSE_LINKS}, {std.SCORES_SQL}, {SIZES_SQL},
top as (select representative from sizes order by size desc, representative limit 20),
members as (select representative, node, authority_score,
    row_number() over (partition by representative order by authority_score desc, node) as place
  from labels join scores on artist = node where representative in (select representative from top))"""


@query(f"with {TOP5_SQL} select representative, node, authority_score, cast(place as int) as place from members where place <= 5")
def cluster_top5(spark, sf):
    return clusters.top_members(std.labels(spark, sf), std.scores(spark, sf))


# --- context of the top artists, hubs and roles -----------------------------

TOP15_SQL = f"""{DENSE_LINKS}, {std.SCORES_SQL},
top as (select artist, row_number() over (order by authority_score desc, artist) as place from scores
  order by place limit 15)"""


@query(
    f"""with {TOP15_SQL}, {LABELS},
c as (select dst as artist, count(*) as total, count(*) filter (s.cluster_id = t.cluster_id) as internal
  from edges left join labels s on s.node = src left join labels t on t.node = dst
  where dst in (select artist from top) group by 1)
select cast(place as int) as place, artist, total as total_samples, internal as internal_samples, total - internal as external_samples,
  round(100.0 * internal / total, 6) as internal_pct, round(100.0 * (total - internal) / total, 6) as external_pct
from top left join c using (artist)"""
)
def authority_context(spark, sf):
    return rounded(
        context.authority_context(
            std.edges(spark, sf, "dense"), std.labels(spark, sf), std.scores(spark, sf, "dense")
        )
    )


@query(
    f"""with {TOP15_SQL},
e as (select src, dst from edges where src in (select artist from top) and dst in (select artist from top)),
c as (select artist, place, count(*) filter (dst = artist and src <> artist) as incoming,
    count(*) filter (src = artist and dst <> artist) as outgoing,
    count(*) filter (src = artist and dst = artist) as self_loops
  from top left join e on src = artist or dst = artist group by 1, 2)
select artist, cast(place as int) as place, incoming, outgoing, self_loops, case when incoming + outgoing > 0 then 'Connected'
  when self_loops > 0 then 'ISOLATED' else 'COMPLETELY ISOLATED' end as status from c"""
)
def top15_connectivity(spark, sf):
    return context.top_connectivity(std.edges(spark, sf, "dense"), std.scores(spark, sf, "dense"))


DEGREES_SQL = """i as (select dst as artist, count(*) as n from edges group by 1),
o as (select src as artist, count(*) as n from edges group by 1),
degrees as (select coalesce(i.artist, o.artist) as artist, coalesce(i.n, 0) as in_degree, coalesce(o.n, 0) as out_degree
  from i full join o on i.artist = o.artist)"""
# P(|T| > t) as one less the density of Student's t between -t and t, by the midpoint rule.
P_SQL = """t as (select *, abs(rho) * sqrt((n - 2) / (1 - rho * rho)) as t, n - 2.0 as v from c),
p as (select any_value(rho) as rho, any_value(n) as n, greatest(0, 1 - 2 * any_value(t) / 100000
    * sum(exp(-(v + 1) / 2 * ln(1 + pow((i + 0.5) * t / 100000, 2) / v)))
    / any_value(sqrt(v) * case when v < 300 then exp(lgamma(v / 2) + lgamma(0.5) - lgamma((v + 1) / 2))
      else sqrt(2 * pi() / v) * (1 + 1 / (4 * v) + 1 / (32 * v * v)) end)) as p
  from t, range(100000) s(i))"""

HUB_SQL = f"""{SPARSE_LINKS}, {std.SCORES_SQL}, {LABELS}, {DEGREES_SQL},
hubs as (select d.artist, in_degree, out_degree, coalesce(authority_score, 0.1) as authority_score,
    coalesce(representative, 'Unknown') as cluster
  from degrees d left join scores s on s.artist = d.artist left join labels on node = d.artist)"""


def hubs(spark, sf):
    return degree.hub_table(std.edges(spark, sf), std.scores(spark, sf), std.labels(spark, sf))


@query(f"with {HUB_SQL} select * from hubs")
def hub_table(spark, sf):
    return hubs(spark, sf)


@query(
    f"""with {HUB_SQL} select artist, in_degree, out_degree, round(sqrt(in_degree * out_degree), 6) as bridge_score
from degrees order by sqrt(in_degree * out_degree) desc, artist limit 15"""
)
def bridge_score(spark, sf):
    return rounded(degree.top_bridges(degree.known_degrees(std.edges(spark, sf))))


@query(
    f"""with {HUB_SQL}, m as (select avg(in_degree + 1) as mi, avg(out_degree + 1) as mo from degrees)
select artist, in_degree, out_degree, case when in_degree + 1 >= mi and out_degree + 1 >= mo then 'Bridge'
  when in_degree + 1 >= mi then 'Authority' when out_degree + 1 >= mo then 'Heavy sampler' else 'Peripheral' end as role
from degrees, m"""
)
def role_quadrant(spark, sf):
    return degree.roles(degree.known_degrees(std.edges(spark, sf)))


@query(f"with {HUB_SQL} select artist, in_degree from hubs order by in_degree desc, artist limit 15")
def top_volume(spark, sf):
    return hubs(spark, sf).orderBy(F.desc("in_degree"), "artist").limit(15).select("artist", "in_degree")


@query(
    f"""with {cat.GRAPH_SQL}, i as (select Original_Artist_Name as artist, count(*) as in_degree from graph group by 1),
o as (select Sampler_Artist_Name as artist, count(*) as out_degree from graph group by 1)
select coalesce(i.artist, o.artist) as artist, coalesce(in_degree, 0) as in_degree, coalesce(out_degree, 0) as out_degree
from i full join o on i.artist = o.artist"""
)
def named_degrees(spark, sf):
    return degree.known_degrees(links.as_edges(cat.music_graph(spark, sf)))


# --- rankings --------------------------------------------------------------

RANK_SQL = f"""{SPARSE_LINKS}, {std.SCORES_SQL},
both_ as (select artist, times_sampled, authority_score
  from (select dst as artist, count(*) as times_sampled from edges group by 1) join scores using (artist)),
ranked as (select *, rank() over (order by times_sampled desc) as vol_rank,
    rank() over (order by authority_score desc) as auth_rank from both_),
compared as (select *, vol_rank - auth_rank as divergence from ranked)"""


def rank_table(spark, sf):
    volume = degree.in_degree(std.edges(spark, sf))
    return ranking.compare_ranks(ranking.volume_and_authority(volume, std.scores(spark, sf)))


@query(f"with {RANK_SQL} select artist, times_sampled, authority_score from both_")
def volume_authority(spark, sf):
    return ranking.volume_and_authority(degree.in_degree(std.edges(spark, sf)), std.scores(spark, sf))


@query(f"with {RANK_SQL} select * from compared")
def rank_vs_rank(spark, sf):
    return rank_table(spark, sf)


@query(
    f"""with {RANK_SQL} select compared.* from compared
join (select c_custkey from customer order by c_acctbal desc, c_custkey limit 9) on artist = c_custkey"""
)
def rank_divergence(spark, sf):
    """The ranks of a watch-list: the nine richest customers."""
    rich = std.table(spark, sf, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(9)
    return ranking.watch(rank_table(spark, sf), rich.select(F.col("c_custkey").alias("artist")))


@query(
    f"""with {SPARSE_LINKS}, {std.SCORES_SQL}
select artist, authority_score, row_number() over (order by authority_score desc, artist) as system_rank from scores"""
)
def system_rank(spark, sf):
    return positions(std.scores(spark, sf), [F.desc("authority_score"), F.asc("artist")], "system_rank")


@query(
    f"""with {HUB_SQL},
r as (select rank() over (order by in_degree) + (count(*) over (partition by in_degree) - 1) / 2 as a,
    rank() over (order by out_degree) + (count(*) over (partition by out_degree) - 1) / 2 as b from degrees),
c as (select corr(a, b) as rho, count(*) as n from r),
{P_SQL}
select round(rho, 6) as rho, n, round(p, 6) as p_value, p > 0.05 as not_significant from p"""
)
def spearman(spark, sf):
    both = degree.known_degrees(std.edges(spark, sf))
    return rounded(ranking.spearman(both, "in_degree", "out_degree", "artist"))


@query(
    f"""with {SPARSE_LINKS}, {std.SCORES_SQL},
keys as (select c_custkey as artist, cast(row_number() over (order by c_acctbal desc, c_custkey) as int) as place
  from customer order by place limit 20)
select artist, place, authority_score from keys left join scores using (artist)"""
)
def in_key_order(spark, sf):
    rich = std.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("artist"), F.col("c_acctbal").alias("authority_score")
    )
    keys = context.numbered(context.top_scored(rich, 20)).select("artist", "place")
    return ranking.in_key_order(std.scores(spark, sf), keys)


# --- cut-outs --------------------------------------------------------------

TOP100_SQL = f"""{SPARSE_LINKS}, {std.SCORES_SQL}, {SIZES_SQL},
top as (select artist as id, authority_score from scores order by authority_score desc, artist limit 100),
sub as (select * from links where src in (select id from top) and dst in (select id from top))"""


def top100(spark, sf):
    return context.top_scored(std.scores(spark, sf), 100).withColumnRenamed("artist", "id")


def top_cut(spark, sf):
    return subgraph.induced(std.links(spark, sf), top100(spark, sf))


@query(f"with {TOP100_SQL} select * from sub")
def induced_subgraph(spark, sf):
    return top_cut(spark, sf)


@query(
    f"""with {TOP100_SQL} select id, count(x) as degree from top left join
  (select src as x from sub union all select dst from sub) on x = id group by id"""
)
def subgraph_degree(spark, sf):
    return subgraph.degree_within(top_cut(spark, sf), top100(spark, sf))


@query(
    f"""with {TOP100_SQL} select src, dst, weight, coalesce(s.representative, 'Unknown') as src_cluster,
  coalesce(t.representative, 'Unknown') as dst_cluster,
  case when s.representative = t.representative then 'intra' else 'inter' end as edge_class
from sub left join labels s on s.node = src left join labels t on t.node = dst"""
)
def edge_class(spark, sf):
    return subgraph.edge_class(top_cut(spark, sf), std.labels(spark, sf))


NETWORK_SQL = f"""{DENSE_LINKS}, {std.SCORES_SQL}, {LABELS},
best as (select artist as id, authority_score from scores order by authority_score desc, artist limit 50),
pairs as (select src, dst, count(*) as weight from edges
  where src in (select id from best) and dst in (select id from best) group by 1, 2 having count(*) >= 2),
x as (select min(authority_score) as a, max(authority_score) as b from best)"""


def drawn(spark, sf):
    return subgraph.top_network(
        std.edges(spark, sf, "dense"), std.scores(spark, sf, "dense"), std.labels(spark, sf), 50, 2
    )


@query(
    f"""with {NETWORK_SQL}
select id, authority_score, coalesce(representative, 'Unknown') as cluster,
  (select count(*) from pairs where src = id) + (select count(*) from pairs where dst = id) as degree,
  round(case when b > a then 500 + 2000 * sqrt(authority_score - a) / sqrt(b - a) else 800 end, 6) as node_size,
  round(4 + 34 * sqrt(authority_score / b), 6) as radius
from best left join labels on node = id, x"""
)
def top_network_nodes(spark, sf):
    return rounded(drawn(spark, sf)[0])


@query(
    f"""with {NETWORK_SQL}, m as (select max(weight) as m from pairs)
select src, dst, weight, coalesce(s.representative, 'Unknown') as src_cluster,
  coalesce(t.representative, 'Unknown') as dst_cluster,
  case when s.representative = t.representative then 'intra' else 'inter' end as edge_class,
  round(0.5 + 2.5 * weight / m, 6) as line_width, round(greatest(0.5, 0.8 * sqrt(weight)), 6) as stroke_width
from pairs left join labels s on s.node = src left join labels t on t.node = dst, m"""
)
def top_network_links(spark, sf):
    return rounded(drawn(spark, sf)[1])


CORE_SQL = f"""{TOP5_SQL}, {DEGREES_SQL},
chosen as (
  select artist as id from (select artist from scores order by authority_score desc, artist limit 200)
  union select artist from (select artist from i order by n desc, artist limit 100)
  union select artist from (select artist from o order by n desc, artist limit 100)
  union select node from members where place <= 5),
core as (select artist as id, authority_score, coalesce(representative, 'Unknown') as cluster
  from scores left join labels on node = artist where artist in (select id from chosen)),
core_links as (select src, dst, sum(weight) as weight from edges
  where src in (select id from core) and dst in (select id from core) group by 1, 2)"""


def core(spark, sf):
    return subgraph.core_nodes(std.edges(spark, sf), std.scores(spark, sf), std.labels(spark, sf))


@query(f"with {CORE_SQL} select * from core")
def core_network_nodes(spark, sf):
    return core(spark, sf)


@query(f"with {CORE_SQL} select * from core_links")
def core_network_links(spark, sf):
    return subgraph.core_links(std.edges(spark, sf), core(spark, sf))


@query(
    f"""with {CORE_SQL}
select 'node' as kind, count(*) as n from core union all select 'link', count(*) from core_links
union all select 'cluster', count(*) from top"""
)
def core_bundle(spark, sf):
    bundle = subgraph.core_bundle(std.edges(spark, sf), std.scores(spark, sf), std.labels(spark, sf))
    return bundle.groupBy("kind").agg(F.count("json").alias("n"))


def heaviest(spark, sf):
    """The node with the highest score, to look at."""
    return context.top_scored(std.scores(spark, sf), 1).first()["artist"]


HEAVIEST_SQL = f"{SPARSE_LINKS}, {std.SCORES_SQL}, top as (select artist from scores order by authority_score desc, artist limit 1)"


@query(
    f"""with {HEAVIEST_SQL} select 'in' as direction, src as neighbour, weight from links, top where dst = artist
union all select 'out', dst, weight from links, top where src = artist"""
)
def ego_network(spark, sf):
    return subgraph.ego(std.links(spark, sf), heaviest(spark, sf))


@query(
    f"""with {HEAVIEST_SQL} select t.artist as id,
  t.artist = (select artist from top) or t.artist in (select src from links, top where dst = artist)
    or t.artist in (select dst from links, top where src = artist) as connected
from (select artist from scores order by authority_score desc, artist limit 5) t"""
)
def adjacency_test(spark, sf):
    """Is each of the five best linked to the best?"""
    five = context.top_scored(std.scores(spark, sf), 5).withColumnRenamed("artist", "id")
    return subgraph.adjacent(std.links(spark, sf), heaviest(spark, sf), five)


@query(f"with {cat.NAMES_SQL} select id, name from names where lower(name) like '%customer 1%'")
def node_search(spark, sf):
    return subgraph.search(cat.names(spark, sf), "Customer 1", "name").select("id", "name")


@query(f"with {HUB_SQL} select * from hubs where cluster = 'NATION_3'")
def cluster_filter(spark, sf):
    return subgraph.of_cluster(hubs(spark, sf), "NATION_3")


@query(
    f"""with {SPARSE_LINKS}, {LABELS} select links.* from links
where src in (select node from labels where representative = 'NATION_3')
  and dst in (select node from labels where representative = 'NATION_3')"""
)
def cluster_links(spark, sf):
    return subgraph.links_of_cluster(std.links(spark, sf), std.labels(spark, sf), "NATION_3")


@query(
    f"""with {SPARSE_LINKS}, {std.SCORES_SQL}, x as (select min(authority_score) as a, max(authority_score) as b from scores)
select artist as id, authority_score,
  round(case when b > a then 500 + 2000 * sqrt(authority_score - a) / sqrt(b - a) else 800 end, 6) as node_size,
  round(4 + 34 * sqrt(authority_score / b), 6) as radius from scores, x"""
)
def node_size(spark, sf):
    return rounded(subgraph.node_sizes(std.scores(spark, sf).withColumnRenamed("artist", "id")))


@query(
    f"""with {SPARSE_LINKS}, x as (select max(weight) as m from links)
select src, dst, weight, round(0.5 + 2.5 * weight / m, 6) as line_width,
  round(greatest(0.5, 0.8 * sqrt(weight)), 6) as stroke_width from links, x"""
)
def edge_width(spark, sf):
    return rounded(subgraph.edge_widths(std.links(spark, sf)))


@query(
    f"""with {HUB_SQL}, c as (select cluster, count(*) as nodes from hubs group by 1)
select * from (select * from c where cluster <> 'Unknown' order by nodes desc, cluster limit 10)
union all select * from c where cluster = 'Unknown'"""
)
def legend_counts(spark, sf):
    return subgraph.legend(hubs(spark, sf))


@query(f"with {cat.NAMES_SQL} select id, substr(name, 1, 12) as label from names")
def short_labels(spark, sf):
    return cat.names(spark, sf).select("id", text.shorten(F.col("name"), 12).alias("label"))


# --- validation against an outside list ------------------------------------

NAMED_SCORES_SQL = f"""{DENSE_LINKS}, {cat.NAMES_SQL},
named as (select name as artist, sum(weight) as authority_score from links join names on dst = id group by 1),
richest as (select c_custkey, cast(row_number() over (order by c_acctbal desc, c_custkey) as int) as ground_truth_rank
  from customer order by ground_truth_rank limit 30)"""


def named_scores(spark, sf):
    names = cat.names(spark, sf).select(F.col("id").alias("dst"), F.col("name").alias("artist"))
    named = spread_join(std.links(spark, sf, "dense").select("dst", "weight"), names, "dst")
    return named.groupBy("artist").agg(F.sum("weight").alias("authority_score"))


def outside_list(spark, sf):
    """The 30 richest customers in order, their names with the words turned round."""
    rich = std.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("artist"), F.col("c_acctbal").alias("authority_score")
    )
    top = context.numbered(context.top_scored(rich, 30)).select(F.col("artist").alias("id"), "place")
    turned = F.array_join(F.reverse(F.split("name", " ")), " ")
    return F.broadcast(top).join(cat.names(spark, sf), "id").select(
        turned.alias("ground_truth"), F.col("place").alias("ground_truth_rank")
    )


@query(
    f"""with {NAMED_SCORES_SQL}
select array_to_string(list_reverse(string_split(name, ' ')), ' ') as ground_truth, ground_truth_rank
from richest join names on id = c_custkey"""
)
def ground_truth_list(spark, sf):
    return outside_list(spark, sf)


@query(
    f"""with {NAMED_SCORES_SQL} select artist, authority_score,
  cast(row_number() over (order by authority_score desc, artist) as bigint) as system_rank
from named order by system_rank limit 100"""
)
def match_candidates(spark, sf):
    """Fewer than there are names, so that the cut is seen."""
    return matching.candidates(named_scores(spark, sf), 100)


LCS_SQL = """list_last(list_reduce(
    list_transform(string_split(only_a, ''), lambda c: [unicode(c)]),
    lambda old, ca: list_reduce(
      list_transform(range(1, length(only_b) + 1), lambda j: [cast(j as int)]),
      lambda acc, j: list_append(acc, case when ca[1] = unicode(only_b[j[1]]) then old[j[1]] + 1
        else greatest(old[j[1] + 1], acc[j[1]]) end),
      [0]),
    list_transform(range(0, length(only_b) + 1), lambda x: 0)))"""

WORDS_SQL = r"list_sort(list_distinct(string_split_regex(trim(regexp_replace(lower(regexp_replace({0}, '[^\x00-\x7F]', '', 'g')), '\W', ' ', 'g')), '\s+')))"

# Both names share their common words as a prefix, so only the rest needs a
# longest common subsequence; the choice is written out name by name.
SIMILAR_SQL = f"""{NAMED_SCORES_SQL},
truth as (select array_to_string(list_reverse(string_split(name, ' ')), ' ') as ground_truth, ground_truth_rank
  from richest join names on id = c_custkey),
pool as (select artist, authority_score, cast(row_number() over (order by authority_score desc, artist) as bigint) as system_rank
  from named),
tw as (select *, {WORDS_SQL.format("ground_truth")} as w from truth),
pw as (select *, {WORDS_SQL.format("artist")} as v from pool),
parts as (select ground_truth, ground_truth_rank, artist, authority_score, system_rank,
    array_to_string(list_sort(list_intersect(w, v)), ' ') as shared,
    array_to_string(list_filter(w, lambda t: not list_contains(v, t)), ' ') as only_a,
    array_to_string(list_filter(v, lambda t: not list_contains(w, t)), ' ') as only_b from tw, pw),
rests as (select only_a, only_b, {LCS_SQL} as lcs
  from (select distinct only_a, only_b from parts where only_a <> '' and only_b <> '')),
lengths as (select *, case when shared = '' then 0 else length(shared) + 1 end as head, length(shared) as s from parts),
scored as (select l.*, cast(case when shared <> '' and (l.only_a = '' or l.only_b = '') then 100
    else greatest(
      case when shared = '' then 0 else round_even(200.0 * s / (s + head + length(l.only_a)), 0) end,
      case when shared = '' then 0 else round_even(200.0 * s / (s + head + length(l.only_b)), 0) end,
      case when l.only_a = l.only_b then 100 else round_even(200.0 * (head + coalesce(lcs, 0)) / (2 * head + length(l.only_a) + length(l.only_b)), 0) end)
    end as int) as match_score
  from lengths l left join rests r on r.only_a = l.only_a and r.only_b = l.only_b),
alike as materialized (select * from scored where match_score >= 85)"""


def choices_sql(n: int) -> str:
    steps = ["m0 as materialized (select * from alike where false)"]
    for k in range(1, n + 1):
        steps.append(
            f"""m{k} as materialized (select * from m{k - 1} union all (select * from alike
  where ground_truth_rank = {k} and artist not in (select artist from m{k - 1})
  order by match_score desc, system_rank limit 1))"""
        )
    return ",\n".join(steps)


MATCH_SQL = f"{SIMILAR_SQL},\n{choices_sql(30)}"


@query(
    f"""with {MATCH_SQL} select ground_truth, ground_truth_rank, artist as matched_artist, system_rank,
  authority_score, match_score from m30"""
)
def fuzzy_match(spark, sf):
    return matching.align(outside_list(spark, sf), named_scores(spark, sf))


@query(
    f"""with {MATCH_SQL},
r as (select rank() over (order by ground_truth_rank) as a, rank() over (order by system_rank) as b from m30),
c as (select corr(a, b) as rho, count(*) as n from r),
{P_SQL}
select metric, round(value, 4) as value from (
  select 'Spearman_Rank_Correlation' as metric, rho as value from c
  union all select 'P_value', p from p
  union all select 'Number_of_ground_truth_artists', count(*) from truth
  union all select 'Number_of_matched_artists', n from c)"""
)
def validation_report(spark, sf):
    truth = outside_list(spark, sf)
    return matching.agreement_report(truth, matching.align(truth, named_scores(spark, sf)))


# --- the same for artists with names, some of which nobody can read ----------

CALLED = """case when c_custkey % 7 = 1 then 'Artist' || chr(9) || c_custkey when c_custkey % 11 = 2 then '[unknown]'
  when c_custkey % 13 = 3 then '[no artist]' else 'Artist ' || c_custkey end"""
CALLED_SQL = f"""{DENSE}, called as (select c_custkey, {CALLED} as name, c_nationkey, c_acctbal from customer),
e as (select s.name as src, t.name as dst, weight from edges join called s on s.c_custkey = src join called t on t.c_custkey = dst),
l as (select src, dst, sum(weight) as weight from e where src <> dst group by 1, 2),
sc as (select dst as artist, sum(weight) as authority_score from l group by 1),
lab as (select name as node, cast(c_nationkey as bigint) as cluster_id, n_name as representative
  from called join nation on c_nationkey = n_nationkey where c_acctbal >= 0 and name like 'Artist%'),
plain as (select artist from (select src as artist from e union select dst from e)
  where length(artist) > 0 and artist not in ('[unknown]', '[no artist]') and not regexp_matches(replace(artist, ' ', ''), '[\\p{{C}}\\p{{Z}}]')),
deg2 as (select artist, (select count(*) from e where dst = artist) as in_degree, (select count(*) from e where src = artist) as out_degree from plain),
hub2 as (select d.artist, in_degree, out_degree, coalesce(authority_score, 0.1) as authority_score, coalesce(representative, 'Unknown') as cluster
  from deg2 d left join sc on sc.artist = d.artist left join lab on node = d.artist)"""


def called(spark, sf):
    """(edges, scores, labels) with names in place of numbers."""
    people = std.table(spark, sf, "customer").withColumn("name", F.expr(CALLED.replace("chr(9)", "char(9)")))
    names = people.select("c_custkey", "name")
    edges = std.edges(spark, sf, "dense").select("src", "dst", "weight")
    edges = Chain(edges, "src", "dst")
    for side in ("src", "dst"):
        edges.join(names.withColumnsRenamed({"c_custkey": side, "name": f"{side}_name"}), side)
    edges = edges.df.select(F.col("src_name").alias("src"), F.col("dst_name").alias("dst"), "weight")
    received = links.collapse(links.drop_self_loops(edges)).groupBy(F.col("dst").alias("artist"))
    nations = std.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("representative"))
    labels = people.where("c_acctbal >= 0 and name like 'Artist%'").join(nations, "c_nationkey")
    labels = labels.select(F.col("name").alias("node"), F.col("c_nationkey").cast("long").alias("cluster_id"), "representative")
    return edges, received.agg(F.sum("weight").alias("authority_score")), labels


@query(f"with {CALLED_SQL} select * from hub2")
def hub_table_named(spark, sf):
    return degree.hub_table(*called(spark, sf))


@query(f"with {CALLED_SQL} select artist, in_degree from hub2 order by in_degree desc, artist limit 15")
def top_volume_named(spark, sf):
    hubs = degree.hub_table(*called(spark, sf))
    return hubs.orderBy(F.desc("in_degree"), "artist").limit(15).select("artist", "in_degree")


@query(
    f"""with {CALLED_SQL}, top as (select artist, row_number() over (order by authority_score desc, artist) as place
  from sc where artist in (select artist from plain) order by place limit 15),
c as (select dst as artist, count(*) as total, count(*) filter (s.cluster_id = t.cluster_id) as internal
  from e left join lab s on s.node = src left join lab t on t.node = dst where dst in (select artist from top) group by 1)
select cast(place as int) as place, artist, total as total_samples, internal as internal_samples, total - internal as external_samples,
  round(100.0 * internal / total, 6) as internal_pct, round(100.0 * (total - internal) / total, 6) as external_pct
from top left join c using (artist)"""
)
def authority_context_named(spark, sf):
    edges, scores, labels = called(spark, sf)
    return rounded(context.authority_context(edges, labels, scores))


@query(
    f"""with {CALLED_SQL}, sized as (select representative, count(*) as size from lab group by 1),
best as (select representative as r, artist from lab join sc on artist = node
  qualify row_number() over (partition by representative order by authority_score desc, artist) = 1)
select representative, size, artist, case when artist in (select artist from plain) then artist || ' Cluster'
  else 'Cluster ' || representative end as label from sized left join best on r = representative"""
)
def cluster_top_artist_named(spark, sf):
    _, scores, labels = called(spark, sf)
    return clusters.top_artist(labels, scores)


# --- sources and sinks -----------------------------------------------------


def fresh_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/roundtrip-{uuid.uuid4().hex}"


@query("select cast(o_orderkey as int) as id, o_orderpriority as name, cast(o_custkey as int) as artist_credit from orders")
def io_dump_roundtrip(spark, sf):
    """Orders written as a headerless dump file and read back by its schema."""
    folder = fresh_folder(spark)
    rows = std.table(spark, sf, "orders").select(
        "o_orderkey", F.lit(None).cast("string").alias("gid"), "o_orderpriority", "o_custkey"
    )
    rows.write.option("sep", "\t").option("nullValue", "\\N").option("quote", "").csv(f"{folder}/recording")
    return dumps.read_dump(spark, folder, "recording").select("id", "name", "artist_credit")


@query("select n_nationkey, n_name, n_regionkey from nation")
def io_csv_roundtrip(spark, sf):
    folder = fresh_folder(spark)
    nations = std.table(spark, sf, "nation")
    sinks.write_csv(nations, folder)
    return spark.read.option("header", True).schema(nations.schema).csv(folder)


#: Texts that a writer or reader may trip over, by the key of a nation.
HOSTILE = """case n_nationkey when 0 then null when 1 then '' when 2 then '"Heroes" live' when 3 then 'say "hi"' when 4 then 'AC{b}DC'
  when 5 then 'ends with {b}' when 6 then 'a' || chr(9) || 'tab' when 7 then 'two' || chr(10) || 'lines' when 8 then ',' when 9 then '"'
  when 10 then '  blanks  ' when 11 then '""' when 12 then '{b}"' when 13 then '{b}N' when 14 then 'Ünï, "cödé"' else n_name end"""


@query(f"select n_nationkey, {HOSTILE.format(b=chr(92))} as text, n_regionkey from nation")
def io_csv_texts(spark, sf):
    """Quotes, separators, line ends, blanks, null and empty text through the CSV sink."""
    folder = fresh_folder(spark)
    text = F.expr(HOSTILE.format(b=chr(92) * 2))
    rows = std.table(spark, sf, "nation").select("n_nationkey", text.alias("text"), "n_regionkey")
    sinks.write_csv(rows, folder)
    return sinks.read_csv(spark, folder, rows.schema)


@query(
    f"""select n_nationkey as id, nullif(nullif(x, ''), '{chr(92)}N') as name, n_regionkey as artist_credit
from (select *, replace(replace({HOSTILE.format(b=chr(92))}, chr(9), ' '), chr(10), ' ') as x from nation)"""
)
def io_dump_texts(spark, sf):
    """Dump lines as they come: quotes and backslashes are plain characters, empty fields and {chr(92)}N are null."""
    folder = fresh_folder(spark)
    text = F.translate(F.expr(HOSTILE.format(b=chr(92) * 2)), "\t\n", "  ")
    field = F.coalesce(text, F.lit("\\N"))
    lines = std.table(spark, sf, "nation").select(F.concat_ws("\t", "n_nationkey", F.lit("gid"), field, "n_regionkey", F.lit("\\N"), F.lit(""), F.lit("0")))
    lines.write.text(f"{folder}/recording")
    return dumps.read_dump(spark, folder, "recording").select("id", "name", "artist_credit")


@query("select * from customer")
def io_parquet_roundtrip(spark, sf):
    folder = fresh_folder(spark)
    return sinks.read_or_compute(spark, folder, lambda: std.table(spark, sf, "customer"))


@query(f"with {cat.ALIAS_SQL} select * from alias_map")
def io_alias_roundtrip(spark, sf):
    folder = fresh_folder(spark)
    sinks.write_alias_map(aliases.build_alias_map(listed(spark, sf)), folder)
    return dumps.read_alias_map(spark, folder)


#: Names in one object, about.
ALIASES = 100_000


@query(f"with {cat.ALIAS_SQL} select * from alias_map")
def io_alias_object(spark, sf):
    """The map as objects over many lines, as people keep it, read back: one for each block of names, so none grows with the table."""
    folder = fresh_folder(spark)
    table = cat.alias_table(spark, sf)
    blocks = table.count() // ALIASES + 1
    pair = F.concat(F.to_json(F.array("variant")), F.lit(":"), F.to_json(F.array("canonical")))
    entry = F.regexp_replace(pair, r'^\["(.*)"\]:\["(.*)"\]$', '  "$1" : "$2"')
    parts = table.select(F.pmod(F.xxhash64("variant"), F.lit(blocks)).alias("block"), entry.alias("e"))
    found = parts.groupBy("block").agg(F.array_join(F.collect_list("e"), ",\n").alias("all"))
    found.select("block", F.concat(F.lit("{\n"), "all", F.lit("\n}")).alias("value")).write.partitionBy("block").text(folder)
    return dumps.read_alias_map(spark, folder)


@query(f"with {cat.ALIAS_SQL} select * from alias_map")
def io_alias_lines(spark, sf):
    """Lines with blanks and the keys the other way round."""
    folder = fresh_folder(spark)
    line = F.to_json(F.struct("canonical", "variant"))
    spaced = F.concat(F.lit("  "), F.regexp_replace(line, r'^\{"canonical":', '{ "canonical" : '), F.lit(" "))
    cat.alias_table(spark, sf).select(spaced.alias("value")).write.text(folder)
    return dumps.read_alias_map(spark, folder)


@query("select n_nationkey, n_name from nation where n_nationkey < 20 order by n_nationkey limit 7")
def io_preview(spark, sf):
    """The first rows in the table's own order."""
    return sinks.preview(std.table(spark, sf, "nation").where("n_nationkey < 20").orderBy("n_nationkey"), 7).select("n_nationkey", "n_name")


@query("select 'ran' as first, 'skipped' as again, count(*) as n, 'missing' as absent from supplier")
def io_stage_gating(spark, sf):
    """A stage runs once, its second call reads what is there, and a missing input is named."""
    folder, seen = fresh_folder(spark), []

    def compute():
        seen.append(1)
        return std.table(spark, sf, "supplier")

    sinks.read_or_compute(spark, folder, compute)
    first = len(seen)
    kept = sinks.read_or_compute(spark, folder, compute)
    try:
        sinks.require(spark, folder, f"{folder}-absent")
        absent = "there"
    except FileNotFoundError as error:
        absent = "missing" if f"{folder}-absent" in str(error) and f"{folder}," not in str(error) else "wrong"
    return kept.agg(F.count("*").alias("n")).select(
        F.lit("ran" if first == 1 else "wrong").alias("first"), F.lit("skipped" if len(seen) == 1 else "wrong").alias("again"),
        "n", F.lit(absent).alias("absent"),
    )


@query(
    """select n_name as name, n_name || case when n_regionkey = 1 then ' the Second' else '' end as resolved, 3 as runs, 2 as computed from nation"""
)
def io_input_manifest(spark, sf):
    """A stage and what follows from it are computed again when an input changes: the alias map is another one in the last of three runs."""
    folder, seen = fresh_folder(spark), []
    names = std.table(spark, sf, "nation").select(F.col("n_name").alias("name"), "n_regionkey")

    def run(region: int) -> DataFrame:
        aliases = names.where(F.col("n_regionkey") == region)
        sinks.write_alias_map(aliases.select(F.col("name").alias("variant"), F.concat("name", F.lit(" the Second")).alias("canonical")), f"{folder}/aliases-{region}")
        kept = stages.Stages(spark, f"{folder}/out", {"aliases": stages.digest(region)})

        def resolved() -> DataFrame:
            seen.append(region)
            known = dumps.read_alias_map(spark, f"{folder}/aliases-{region}").withColumnRenamed("variant", "name")
            return names.join(known, "name", "left").select("name", F.coalesce("canonical", "name").alias("resolved"))

        kept.add("resolved.parquet", ["aliases"], resolved)
        kept.add("copy.parquet", ["resolved.parquet"], lambda: kept.table("resolved.parquet"))
        kept.run()
        return kept.table("copy.parquet")

    for region in (0, 0, 1):
        found = run(region)
    return found.withColumns({"runs": F.lit(3), "computed": F.lit(len(seen))})


@query(f"with {CORE_SQL} select id, authority_score as pagerank, cluster from core")
def io_bundle_roundtrip(spark, sf):
    folder = fresh_folder(spark)
    sinks.write_bundle(
        subgraph.core_bundle(std.edges(spark, sf), std.scores(spark, sf), std.labels(spark, sf)), folder
    )
    return spark.read.schema("id long, pagerank double, cluster string").json(f"{folder}/kind=node")


@query(
    f"""with {CORE_SQL}
select 'link' as kind, cast(src as varchar) as a, cast(dst as varchar) as b, weight from core_links
union all select 'cluster', representative, cast(row_number() over (order by size desc, representative) as varchar), null
from sizes qualify row_number() over (order by size desc, representative) <= 20"""
)
def io_bundle_links_and_clusters(spark, sf):
    """The other two kinds, read back; clusters carry their place by size."""
    folder = fresh_folder(spark)
    sinks.write_bundle(
        subgraph.core_bundle(std.edges(spark, sf), std.scores(spark, sf), std.labels(spark, sf)), folder
    )
    link = spark.read.schema("source string, target string, weight double").json(f"{folder}/kind=link")
    cluster = spark.read.schema("rank string, representative string").json(f"{folder}/kind=cluster")
    return link.select(F.lit("link").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"), "weight").unionByName(
        cluster.select(F.lit("cluster").alias("kind"), F.col("representative").alias("a"), F.col("rank").alias("b"), F.lit(None).cast("double").alias("weight"))
    )


# --- the salted path, which these tables are too small to reach by themselves --


@contextmanager
def small_blocks(spark: SparkSession, rows: int):
    """Blocks of a few rows and no broadcast by size while a plan is built."""
    spark.conf.set("spark.tributary.blockRows", str(rows))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.tributary.blockRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def salted(name: str, build, rows: int = 20):
    """Register `name` run with small blocks beside the same SQL."""
    function, sql = REGISTRY[name]

    def run(spark, sf):
        with small_blocks(spark, rows):
            return handoff((build or function)(spark, sf), f"{name}-salted")

    run.__name__ = f"{name}_salted"
    REGISTRY[run.__name__] = (run, sql)


salted("edges_build", lambda spark, sf: std.derive_edges(spark, sf, "dense"))
salted("graph_build", lambda spark, sf: build.build_graph(cat.tables(spark, sf), cat.alias_table(spark, sf)))
salted("release_year", None)
salted("edge_class", None)
salted("null_counts", None)
salted("modularity_given", None)
salted("edge_cluster_mix", None)
salted("pagerank_dense", None, 200)


# --- everything in one go ----------------------------------------------------


#: Results whose content SQL can foretell: data set -> ((column there, the same in SQL) ..., where SQL finds it).
CONTENT = {
    "music_graph.parquet": (
        [(c, c) for c in ("source_song_id", "target_song_id", "Sampler_Artist_Name", "Sampler_Artist_GID", "Sampler_Song_Title",
                          "Sampler_Release_Year", "Original_Artist_Name", "Original_Artist_GID", "Original_Song_Title", "Original_Release_Year")]
        + [("cast(weight * 2 as int)", "cast(weight * 2 as int)")], "graph"),
    "artist_links.parquet": ([("src", "s"), ("dst", "o"), ("cast(weight * 2 as int)", "cast(w * 2 as int)")], "l"),
    "degrees.parquet": ([("artist", "artist"), ("in_degree", "i"), ("out_degree", "u")], "both_degrees"),
    "degree_frequency.parquet": ([("degree", "i"), ("frequency", "f")], "(select i, count(*) as f from both_degrees where i > 0 group by 1)"),
    "degree_frequency.csv": ([("degree", "i"), ("frequency", "f")], "(select i, count(*) as f from both_degrees where i > 0 group by 1)"),
    "in_degree.csv": ([("artist", "artist"), ("times_sampled", "i")], "(select * from both_degrees where i > 0)"),
    "out_degree.csv": ([("artist", "artist"), ("samples_used", "u")], "(select * from both_degrees where u > 0)"),
    "top_songs.csv": ([("artist", "a"), ("title", "t"), ("times_used", "n")],
                      "(select Original_Artist_Name as a, Original_Song_Title as t, count(*) as n from graph group by 1, 2)"),
    "hubs.parquet": ([("artist", "artist"), ("in_degree", "i"), ("out_degree", "u")], "both_degrees"),
    "self_loops.csv": ([("artist", "s"), ("self_sample_count", "n")], "(select * from pairs where s = o and s in (select s from nodes))"),
    "artist_pagerank.parquet": ([("artist", "s")], "nodes"),
    "music_labels.parquet": ([("artist_name", "s")], "nodes"),
    "music_cluster_membership.csv": ([("artist_name", "s")], "nodes"),
    "null_counts.csv": ([("metric", "m"), ("cast(cast(value as double) as int)", "0")],
                        "(select unnest(['null_source', 'null_target', 'null_sampler', 'null_original']) as m)"),
}


#: Of results that depend on communities or ranks, what SQL can foretell: data set -> (aggregate there, the same in SQL).
TOTALS = {
    "top_100_artists_pagerank.csv": ("count(*)", "(select least(100, count(*)) from nodes)"),
    "validation_summary.csv": ("count(*)", "16"), "cluster_quality_summary.csv": ("count(*)", "7"), "statistics_summary.csv": ("count(*)", "15"),
    "cluster_flow.parquet": ("sum(n)", "(select count(*) from graph)"),
    "music_clusters.csv": ("count_if(double(cluster_size) > 0)", None),
    "cluster_sizes.csv": ("sum(double(cluster_size))", "(select count(*) from nodes)"),
    "cluster_top_artists.csv": ("sum(double(size))", "(select count(*) from nodes)"),
    "cluster_density.csv": ("count_if(abs(double(density) * double(size) * (double(size) - 1) - double(internal_edges)) > 1e-6 * double(internal_edges))", "0"),
    "cluster_bridges.csv": ("count_if(From_Cluster = To_Cluster or double(Connection_Strength) < 1)", "0"),
    "concentration.csv": ("count(*)", "2"),
    "top_network_nodes.csv": ("count(distinct id)", "(select least(50, count(*)) from nodes)"),
    "top_network_links.csv": ("count_if((src_cluster = dst_cluster and src_cluster <> 'Unknown') <> (edge_class = 'intra'))", "0"),
    "bridge_artists.csv": ("count(distinct artist)", "(select least(15, count(*)) from both_degrees)"),
    "authority_context.csv": ("count_if(double(total_samples) <> double(internal_samples) + double(external_samples)) * 1000 + count(*)", "(select least(15, count(*)) from nodes)"),
    "top_connectivity.csv": ("sum(double(place))", "(select least(15, count(*)) * (least(15, count(*)) + 1) / 2 from nodes)"),
    "power_law.csv": ("count_if(abs(double(slope) + double(gamma)) < 1e-9)", "1"),
    "external_validation.csv": ("count(distinct matched_artist) - count(*)", "0"),
    "external_validation.parquet": ("count_if(match_score < 85)", "0"),
    "external_validation_meta.csv": ("sum(if(metric = 'Number_of_ground_truth_artists', cast(value as double), 0))", "30"),
    "cluster_size_histogram.csv": ("sum(double(`count`))", None),
    "core_network.json": ("count_if(kind = 'node' and get_json_object(value, '$.id') is null)", "0"),
    "artist_aliases.json": ("count_if(get_json_object(value, '$.variant') = get_json_object(value, '$.canonical'))", "0"),
}


def digest_sql(name: str) -> str:
    columns, source = CONTENT[name]
    text = ", ".join(f"coalesce(cast({c} as varchar), '~')" for _, c in columns)
    number = f"cast('0x' || substr(md5(concat_ws('|', {text})), 1, 8) as bigint)"
    return f"select '{name}' as dataset, count(*) as n, cast(sum({number}) as bigint) as digest from {source}"


def digest(df: DataFrame, name: str) -> DataFrame:
    text = [F.coalesce(F.expr(c).cast("string"), F.lit("~")) for c, _ in CONTENT[name][0]]
    number = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count("*").alias("n"), F.sum(number).alias("digest")).select(F.lit(name).alias("dataset"), "n", "digest")


@query(
    f"""with {cat.GRAPH_SQL},
pairs as (select Sampler_Artist_Name as s, Original_Artist_Name as o, count(*) as n, sum(weight) as w from graph group by 1, 2),
l as (select * from pairs where s <> o),
nodes as (select s from l union select o from l),
both_degrees as (select s as artist, cast(sum(i) as bigint) as i, cast(sum(u) as bigint) as u
  from (select s, 0 as i, n as u from pairs union all select o, n, 0 from pairs) group by 1)
{" union all ".join(digest_sql(n) for n in CONTENT)}
{" ".join(f"union all select '{n}', null, cast({sql} as bigint)" for n, (_, sql) in TOTALS.items() if sql)}
union all select 'clusters agree', null, 1"""
)
def whole_workflow(spark, sf):
    """All stages on dump files of the stand-in tables; content of the results SQL can foretell, totals and rules of the others.

    The numbers of clusters in four results must agree with each other.
    """
    folder = fresh_folder(spark)
    side_by_side(
        spark,
        lambda: cat.write_dump(spark, sf, f"{folder}/dump"),
        lambda: sinks.write_alias_map(aliases.build_alias_map(listed(spark, sf)), f"{folder}/aliases"),
    )
    written = workflow.run_all(spark, f"{folder}/dump", f"{folder}/out", f"{folder}/aliases")
    opened = lambda name, path: (
        spark.read.parquet(path) if name.endswith("parquet") else spark.read.text(path) if name.endswith("json")
        else spark.read.option("header", True).option("escape", '"').csv(path)
    )
    none, read = F.lit(None).cast("long"), {}

    def seen(name):
        """One row on a result; each by itself, as one plan over all of them would fill the driver's memory."""
        read[name] = opened(name, written[name])
        if name in CONTENT:
            return digest(read[name], name).first()
        total, sql = TOTALS.get(name, (None, None))
        if sql:
            return read[name].agg(F.expr(total).cast("long").alias("digest")).select(F.lit(name).alias("dataset"), none.alias("n"), "digest").first()

    with ThreadPoolExecutor(4) as pool:
        rows = [row for row in pool.map(seen, written) if row]
    found = [read["cluster_sizes.csv"].agg(F.count("*")), read["cluster_top_artists.csv"].agg(F.count("*")),
             read["cluster_size_histogram.csv"].agg(F.expr(TOTALS["cluster_size_histogram.csv"][0]).cast("long")),
             read["cluster_quality_summary.csv"].where("metric = 'num_clusters'").agg(F.max(F.col("value").cast("double")).cast("long")),
             read["music_cluster_membership.csv"].agg(F.countDistinct("cluster_id"))]
    same = F.array_max(F.array(*[f.scalar() for f in found])) == F.array_min(F.array(*[f.scalar() for f in found]))
    shown = read["music_clusters.csv"].agg(F.expr(TOTALS["music_clusters.csv"][0])).scalar() == F.least(F.lit(100), found[0].scalar())
    rows.append(spark.range(1).select(F.lit("clusters agree").alias("dataset"), none.alias("n"), (same & shown).cast("long").alias("digest")).first())
    return spark.createDataFrame(rows, "dataset string, n long, digest long")
