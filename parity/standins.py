"""Stand-in catalogue tables derived from the given star-schema tables.

An order plays a song, a customer an artist. A later order that uses the same
material again reuses the order that used it before; the order priority plays
the relation type. `dense` takes the part as the material, `sparse` the part
from one supplier. Every derivation reads the whole tables and exists twice:
as DataFrame code and as SQL text for the comparison engine.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.lag import previous_in_group
from tributary.operators.links import collapse, drop_self_loops, link_weight
from tributary.operators.skew import Chain
from tributary.session import handoff

# The priorities that play the relation types.
FULL = ["1-URGENT", "2-HIGH"]
HALF = ["3-MEDIUM", "4-NOT SPECIFIED"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MATERIAL = {"dense": ["l_partkey"], "sparse": ["l_partkey", "l_suppkey"]}


def derive_reuse(spark: SparkSession, sf: str, density: str) -> DataFrame:
    """reuse(entity0, entity1): each use of a material with the use before it."""
    keys = MATERIAL[density]
    uses = table(spark, sf, "lineitem").select(*keys, "l_orderkey")
    linked = previous_in_group(uses, keys, "l_orderkey", "entity1")
    return linked.select(F.col("l_orderkey").alias("entity0"), "entity1")


def derive_edges(spark: SparkSession, sf: str, density: str) -> DataFrame:
    """Song-level edges with both artists and both years."""
    songs = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    reuse = derive_reuse(spark, sf, density).where(F.col("entity1").isNotNull())
    reuse = reuse.select(F.col("entity0").alias("source_song_id"), F.col("entity1").alias("target_song_id"))
    samplers = songs.where(F.col("o_orderpriority").isin(FULL + HALF)).select(
        F.col("o_orderkey").alias("source_song_id"),
        F.col("o_custkey").alias("src"),
        link_weight(F.col("o_orderpriority"), FULL, HALF).alias("weight"),
        F.year("o_orderdate").alias("sampler_year"),
    )
    originals = songs.select(
        F.col("o_orderkey").alias("target_song_id"),
        F.col("o_custkey").alias("dst"),
        F.year("o_orderdate").alias("original_year"),
    )
    joined = Chain(reuse, "source_song_id", "target_song_id").join(samplers, "source_song_id").join(originals, "target_song_id").df
    return joined.select(
        "source_song_id", "target_song_id", "weight", "src", "dst", "sampler_year", "original_year"
    )


@cache
def _kept(app: str, spark: SparkSession, sf: str, what: str, density: str) -> DataFrame:
    if what == "reuse":
        return handoff(derive_reuse(spark, sf, density), f"{density}-reuse")
    if what == "edges":
        return handoff(derive_edges(spark, sf, density), f"{density}-edges")
    if what == "links":
        return handoff(collapse(drop_self_loops(edges(spark, sf, density))), f"{density}-links")
    if what == "scores":
        return handoff(derive_scores(spark, sf, density), f"{density}-scores")
    return handoff(derive_labels(spark, sf), "labels")


def reuse(spark: SparkSession, sf: str, density: str) -> DataFrame:
    """The untyped reuse pairs, written once per application like the tables below."""
    return _kept(spark.sparkContext.applicationId, spark, sf, "reuse", density)


def edges(spark: SparkSession, sf: str, density: str = "sparse") -> DataFrame:
    """The edge table, derived and written once per application and read by later stages."""
    return _kept(spark.sparkContext.applicationId, spark, sf, "edges", density)


def links(spark: SparkSession, sf: str, density: str = "sparse") -> DataFrame:
    """The artist links of the edge table, kept the same way."""
    return _kept(spark.sparkContext.applicationId, spark, sf, "links", density)


def derive_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Given labels: the customer's nation; customers in debt have none."""
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("representative")
    )
    solvent = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    return solvent.join(nations, "c_nationkey").select(
        F.col("c_custkey").alias("node"),
        F.col("c_nationkey").cast("long").alias("cluster_id"),
        "representative",
    )


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(spark.sparkContext.applicationId, spark, sf, "labels", "")


LABELS_SQL = """labels as (
  select c_custkey as node, cast(c_nationkey as bigint) as cluster_id, n_name as representative
  from customer join nation on c_nationkey = n_nationkey where c_acctbal >= 0)"""


def derive_scores(spark: SparkSession, sf: str, density: str) -> DataFrame:
    """A cheap stand-in for authority: the weight an artist receives."""
    received = links(spark, sf, density).groupBy(F.col("dst").alias("artist"))
    return received.agg(F.sum("weight").alias("authority_score"))


def scores(spark: SparkSession, sf: str, density: str = "sparse") -> DataFrame:
    return _kept(spark.sparkContext.applicationId, spark, sf, "scores", density)


SCORES_SQL = "scores as (select dst as artist, sum(weight) as authority_score from links group by dst)"


def edges_sql(density: str = "sparse") -> str:
    material = ", ".join(MATERIAL[density])
    return f"""reuse as (
  select l_orderkey as entity0,
         lag(l_orderkey) over (partition by {material} order by l_orderkey) as entity1
  from lineitem),
edges as (
  select e.entity0 as source_song_id, e.entity1 as target_song_id,
         cast(case when o0.o_orderpriority in ('1-URGENT', '2-HIGH') then 1.0 else 0.5 end as double) as weight,
         o0.o_custkey as src, o1.o_custkey as dst,
         year(o0.o_orderdate) as sampler_year, year(o1.o_orderdate) as original_year
  from reuse e
  join orders o0 on e.entity0 = o0.o_orderkey
  join orders o1 on e.entity1 = o1.o_orderkey
  where o0.o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))"""


def links_sql(density: str = "sparse") -> str:
    return f"""{edges_sql(density)},
links as (select src, dst, sum(weight) as weight from edges where src <> dst group by src, dst)"""
