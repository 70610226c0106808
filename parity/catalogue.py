"""Catalogue-shaped stand-ins: names, credits, relations and release chains."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parity.standins import reuse, table
from tributary.functions.text import CONJUNCTIONS, QUALIFIERS
from tributary.operators.aliases import build_alias_map, name_list
from tributary.plans.build import build_graph
from tributary.session import handoff
from tributary.sources.dumps import SCHEMAS

# The relation types each order priority plays; 5-LOW is no reuse.
RELATION_OF = {"1-URGENT": 69, "2-HIGH": 231, "3-MEDIUM": 230, "4-NOT SPECIFIED": 232, "5-LOW": 11}


def names(spark: SparkSession, sf: str) -> DataFrame:
    """artist(id, gid, name): ten customers share a base name in ten spellings."""
    key = F.col("c_custkey")
    base = F.concat(F.lit("Dj Customer "), F.floor(key / 10).cast("string"))
    kind = key % 10
    spelled = (
        F.when(kind == 0, base)
        .when(kind == 1, F.concat(base, F.lit(" feat. Guest")))
        .when(kind == 2, F.concat(base, F.lit(" & The Band")))
        .when(kind == 3, F.concat(base, F.lit(" (Remix)")))
        .when(kind == 4, F.concat(base, F.lit(", The")))
        .when(kind == 5, F.replace(base, F.lit(" "), F.lit("  ")))
        .when(kind == 6, F.lower(base))
        .when(kind == 7, F.concat(base, F.lit(" Trio")))
        .when((kind == 8) & (key % 100 == 8), F.lit("[unknown]"))
        .when(kind == 8, F.replace(base, F.lit(" "), F.lit("‐")))
        .otherwise(F.concat(base, F.lit(" ft. Someone")))
    )
    return table(spark, sf, "customer").select(
        key.alias("id"), key.cast("string").alias("gid"), spelled.alias("name")
    )


NAMES_SQL = """names as (
  select c_custkey as id, cast(c_custkey as varchar) as gid,
    case c_custkey % 10 when 0 then b when 1 then b || ' feat. Guest' when 2 then b || ' & The Band'
      when 3 then b || ' (Remix)' when 4 then b || ', The' when 5 then replace(b, ' ', '  ')
      when 6 then lower(b) when 7 then b || ' Trio'
      when 8 then case when c_custkey % 100 = 8 then '[unknown]' else replace(b, ' ', '‐') end
      else b || ' ft. Someone' end as name
  from (select c_custkey, 'Dj Customer ' || cast(c_custkey // 10 as bigint) as b from customer) t)"""


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '(?i)\s+(feat\.?|ft\.?)\s+.*', '')"


def clean_sql(x: str) -> str:
    x = rf"regexp_replace({x}, '(?i)\s+&\s+', ' and ', 'g')"
    x = rf"regexp_replace({x}, '[\x{{2010}}-\x{{2015}}\x{{2212}}]', '-', 'g')"
    x = rf"regexp_replace({x}, '[\x{{2018}}-\x{{201B}}\x{{2032}}\x{{2035}}]', '''', 'g')"
    x = rf"regexp_replace({x}, '\s*\([^)]*\)\s*$', '')"
    x = rf"regexp_replace({x}, '^(.+),\s+(The)\s*$', '\2 \1')"
    x = rf"regexp_replace({x}, '\s+', ' ', 'g')"
    return f"trim({x})"


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The nine catalogue tables.

    A song is an order, credited to its customer first and to the next customer
    second. Its tracks are its line items, the parts are media, the part sizes
    releases, and seven groups of sizes carry the years of the suppliers.
    """
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    customers, suppliers = table(spark, sf, "customer"), table(spark, sf, "supplier")
    recording = orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Song "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").alias("artist_credit"),
    )
    credit = F.col("c_custkey").alias("artist_credit")
    credits = customers.select(credit, F.lit(0).alias("position"), F.col("c_custkey").alias("artist")).unionByName(
        customers.select(credit, F.lit(1).alias("position"), (F.col("c_custkey") + 1).alias("artist"))
    )
    kind = F.lit(None).cast("int")
    for priority, number in RELATION_OF.items():
        kind = F.when(F.col("o_orderpriority") == priority, number).otherwise(kind)
    link = orders.select(F.col("o_orderkey").alias("id"), kind.alias("link_type"))
    relations = reuse(spark, sf, "dense").where(F.col("entity1").isNotNull())
    relations = relations.select(F.col("entity0").alias("link"), "entity0", "entity1")
    track = lines.select(F.col("l_orderkey").alias("recording"), F.col("l_partkey").alias("medium"))
    parts = table(spark, sf, "part")
    medium = parts.select(F.col("p_partkey").alias("id"), (F.col("p_size")).alias("release"))
    sized = parts.select("p_size").distinct()
    release = sized.select(F.col("p_size").alias("id"), (F.col("p_size") % 7).alias("release_group"))
    meta = suppliers.groupBy((F.col("s_suppkey") % 7).alias("id")).agg(
        (1990 + F.max("s_nationkey")).alias("first_release_date_year")
    )
    return {
        "recording": recording,
        "artist": names(spark, sf),
        "artist_credit_name": credits,
        "link": link,
        "l_recording_recording": relations,
        "track": track,
        "medium": medium,
        "release": release,
        "release_group_meta": meta,
    }


def write_dump(spark: SparkSession, sf: str, folder: str) -> None:
    """The nine tables as headerless dump files, written side by side; columns nobody reads are null."""

    def write(name: str, df: DataFrame) -> None:
        schema = StructType.fromDDL(SCHEMAS[name])
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
        ]
        writer = df.select(columns).write.option("sep", "\t").option("nullValue", "\\N").option("quote", "")
        writer.csv(f"{folder}/{name}")

    given = tables(spark, sf)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, given.keys(), given.values()))


@cache
def _aliases(app: str, spark: SparkSession, sf: str) -> DataFrame:
    return handoff(build_alias_map(name_list(names(spark, sf), "name")), "aliases")


def alias_table(spark: SparkSession, sf: str) -> DataFrame:
    """The alias map, written once per application; its true size decides how it is joined."""
    return _aliases(spark.sparkContext.applicationId, spark, sf)


@cache
def _graph(app: str, spark: SparkSession, sf: str) -> DataFrame:
    return handoff(build_graph(tables(spark, sf), alias_table(spark, sf)), "music_graph")


def music_graph(spark: SparkSession, sf: str) -> DataFrame:
    """The built graph, written once per application."""
    return _graph(spark.sparkContext.applicationId, spark, sf)


def listed_sql(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


QUALIFIES_SQL = f"""(regexp_replace(rest[1], '\\.+$', '') in ({listed_sql(CONJUNCTIONS)})
  or rest[len(rest)] in ({listed_sql(QUALIFIERS)}))"""

ALIAS_SQL = rf"""{NAMES_SQL},
listed as (select distinct name from names where name is not null and name not in ('', '[unknown]', '[no artist]')),
keyed as (
  select name, trim(regexp_replace(lower(name), '\s+', ' ', 'g')) as key, trim(lower(name)) as case_key from listed),
known as (select key as prefix, max(name) as canonical from keyed group by key),
words as (select name, string_split(key, ' ') as w from keyed),
cuts as (
  select name, n, array_to_string(w[1:n], ' ') as prefix, w[n + 1:] as rest
  from (select name, w, unnest(range(2, len(w))) as n from words)),
prefix_alias as (
  select name as variant, arg_max(canonical, n) as canonical
  from cuts join known using (prefix)
  where {QUALIFIES_SQL} and lower(canonical) <> lower(name) group by name),
best as (
  select case_key, first(name order by not regexp_matches(name, '^\p{{Lu}}'), not regexp_matches(name, '^\p{{L}}'),
         length(name), name) as canonical
  from keyed group by case_key having count(*) > 1),
case_alias as (
  select name as variant, canonical from keyed join best using (case_key) where name <> canonical),
alias_map as (
  select coalesce(p.variant, c.variant) as variant, coalesce(p.canonical, c.canonical) as canonical
  from prefix_alias p full join case_alias c on p.variant = c.variant)"""

CREDITS_SQL = f"""{ALIAS_SQL},
credits as (
  select id, {clean_sql("coalesce(canonical, stripped)")} as name, gid
  from (select id, gid, {strip_sql("name")} as stripped from names)
  left join alias_map on stripped = variant)"""

YEARS_SQL = """meta as (
  select s_suppkey % 7 as id, 1990 + max(s_nationkey) as first_release_date_year from supplier group by 1),
years as (
  select l_orderkey as recording, min(first_release_date_year) as release_year
  from lineitem join part on l_partkey = p_partkey join meta on p_size % 7 = meta.id group by 1)"""

GRAPH_SQL = f"""{CREDITS_SQL},
{YEARS_SQL},
reuse as (
  select l_orderkey as entity0, lag(l_orderkey) over (partition by l_partkey order by l_orderkey) as entity1
  from lineitem),
songs as (
  select o_orderkey as id, 'Song ' || cast(o_orderkey as varchar) as title, name, gid, release_year as year
  from orders join credits on o_custkey = credits.id left join years on o_orderkey = recording),
graph as (
  select entity0 as source_song_id, entity1 as target_song_id,
    cast(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1.0 else 0.5 end as double) as weight,
    s.name as Sampler_Artist_Name, s.gid as Sampler_Artist_GID, s.title as Sampler_Song_Title,
    s.year as Sampler_Release_Year,
    t.name as Original_Artist_Name, t.gid as Original_Artist_GID, t.title as Original_Song_Title,
    t.year as Original_Release_Year
  from reuse join orders on entity0 = o_orderkey join songs s on s.id = entity0 join songs t on t.id = entity1
  where o_orderpriority <> '5-LOW' and s.gid <> t.gid
    and not regexp_matches(s.name, '\\[unknown\\]|\\[no artist\\]')
    and not regexp_matches(t.name, '\\[unknown\\]|\\[no artist\\]'))"""
