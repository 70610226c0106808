"""Registered queries of this folder: name -> (function of (spark, folder), SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    collocations,
    decision_list,
    decontaminate,
    html,
    inner_products,
    interpolation,
    lexical,
    licences,
    packing,
    rule_ensemble,
    simhash,
    tokens,
    url_lists,
)
from tributary.llm.common import fold_bucket

REGISTRY: dict[str, tuple] = {}


def query(sql: str | None = None):
    def register(function):
        REGISTRY[function.__name__] = (function, sql)
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op2_simhash_near_dedup(spark, folder):
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), simhash.hexadecimal("fingerprint").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


OP9 = """
with words as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), items as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
), places as (
  select item_id, w, least(len(w), 10) as size, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
  from items where len(w) > 0
), windows as (
  select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as win from places
), sizes as (
  select distinct size from windows
), starts as (
  select row, w, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size
), grams as (
  select row, i, size, array_to_string(w[i:i + size - 1], ' ') as win from starts
), found as (
  select g.row, g.i, g.size, x.item_id from grams g join windows x on g.win = x.win and g.size = x.size
), hit as (
  select row, count(distinct p) as n_hit
  from (select row, unnest(range(i, i + size)) as p from (select distinct row, i, size from found)) group by row
), named as (
  select row, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct row, cast(item_id as varchar) as id from found) group by row
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (row) left join named using (row)
"""


@query(OP9)
def op9_benchmark_decontamination(spark, folder):
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = decontaminate.hits()
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query()
def op3_best_fit_packing(spark, folder):
    pieces = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query()
def op4_token_counts(spark, folder):
    counts = tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit")
    )


@query()
def op7_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    model = rule_ensemble.fit(docs, table(spark, folder, "labels"))
    scored = rule_ensemble.classify(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", (fold_bucket("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query()
def op8_quality_rules(spark, folder):
    docs = table(spark, folder, "documents")
    rules = decision_list.fit(docs, table(spark, folder, "labels"))
    return decision_list.judge(docs, rules, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query()
def op6_html_extraction(spark, folder):
    pages = table(spark, folder, "pages")
    found = html.extract(pages, html.fit(pages))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@query()
def op1_deleted_interpolation(spark, folder):
    return interpolation.scores(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


#: A dated list that Spark (and the SQL below) derives from the captures: every host is denied, taken off and denied again; the
#: domain above it is allowed for a while; the first folder of each host is allowed or denied from some day on.
LISTS = """
with seen as (
  select regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host, regexp_extract(url, '^[a-z]+://[^/?#]+/([a-z]+)/', 1) as folder,
         page_id from pages where url is not null
), hosts as (
  select host, min(page_id) as m, count(*) as n from seen where host <> '' group by host
), domains as (
  select regexp_replace(host, '^(www|m|blog)[.]', '') as domain, min(m) as m, sum(n) as n from hosts group by 1
), folders as (
  select host, folder, min(page_id) as m, count(*) as n from seen where host <> '' and folder <> '' group by host, folder
)
select 'hosts' as list, 'domain' as kind, host as pattern, 'add' as action, 'deny' as verdict,
       date '2024-01-01' + cast(m * 7 % 200 as int) as day from hosts
union all select 'hosts', 'domain', host, 'remove', 'deny', date '2024-01-01' + cast(m * 7 % 200 + 40 + n % 30 as int) from hosts
union all select 'hosts', 'domain', host, 'add', 'deny', date '2024-01-01' + cast(m * 7 % 200 + 150 as int) from hosts
union all select 'domains', 'domain', domain, 'add', 'allow', date '2024-01-01' + cast(m * 11 % 300 as int) from domains
union all select 'domains', 'domain', domain, 'remove', 'allow', date '2024-01-01' + cast(m * 11 % 300 + 5 + n % 60 as int) from domains
union all select 'folders', 'prefix', host || '/' || folder, 'add', case when m % 2 = 0 then 'deny' else 'allow' end,
       date '2024-01-01' + cast(m * 13 % 340 as int) from folders
"""
CAPTURES = "select page_id, url, date '2024-01-01' + cast(page_id * 37 % 366 as int) as fetched from pages"

OP10 = f"""
with entries as ({LISTS}), captures as ({CAPTURES}),
numbered as (
  select *, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host,
         regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '^/+|/+$', '', 'g') as path, row_number() over () as r
  from captures
), parts as (
  select r, fetched, string_split(host, '.') as labels, host, string_split(path, '/') as segments, path from numbered where host <> ''
), tried as (
  select r, fetched, 'domain' as kind, array_to_string(labels[i:], '.') as pattern, 1 as a, -(len(labels) - i + 1) as b
  from (select *, unnest(range(1, len(labels) + 1)) as i from parts)
  union all
  select r, fetched, 'prefix', host || '/' || array_to_string(segments[1:i], '/'), 0, -i
  from (select *, unnest(range(1, len(segments) + 1)) as i from parts where path <> '')
), dated as (
  select list, kind, pattern, day, bool_and(action = 'add') as adds, bool_or(action = 'add' and verdict = 'deny') as deny
  from entries group by all
), lists as (
  select distinct list from dated
), asof_entry as (
  select t.r, t.a, t.b, d.adds, d.deny, d.list, d.pattern, d.day as since
  from (select * from tried, lists) t asof join dated d
    on t.list = d.list and t.kind = d.kind and t.pattern = d.pattern and t.fetched >= d.day
), best as (
  select r, arg_min({{'v': case when deny then 'deny' else 'allow' end, 'pattern': pattern, 'list': list, 'since': since}},
                    {{'a': a, 'b': b, 'c': not deny, 'list': list, 'pattern': pattern}}) as x
  from asof_entry where adds group by r
)
select page_id, url, fetched, coalesce(x.v, 'unlisted') as verdict, x.pattern as pattern, x.list as list, x.since as since
from numbered left join best using (r)
"""


@query(OP10)
def op10_url_lists(spark, folder):
    pages = table(spark, folder, "pages")
    entries, captures = spark.sql(LISTS.replace("from pages", "from {pages}"), pages=pages), spark.sql(CAPTURES.replace("from pages", "from {pages}"), pages=pages)
    return url_lists.judge(captures, entries.withColumnRenamed("day", "at")).withColumnRenamed("id", "page_id")


@query()
def op5_licence_scan(spark, folder):
    docs = table(spark, folder, "documents")
    found = licences.scan(docs, licences.fit(docs))
    families = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["family"])))
    return found.select(
        F.col("id").alias("doc_id"), "n_paragraphs", F.size("found").cast("long").alias("n_notices"),
        F.concat_ws(",", families).alias("families"), F.array_min(F.transform("found", lambda f: f["paragraph"])).alias("first_notice"),
        F.array_max(F.transform("found", lambda f: f["probability"])).alias("probability"),
    )


OP13 = """
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), texts as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), starts as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from texts
), counts as (
  select lang, w[i:i + d - 1] as p, d, count(*) as f from (select *, unnest([1, 2, 3, 4]) as d from starts) where i + d - 1 <= len(w)
  group by all
), totals as (
  select lang, sum(f) as n from counts where d = 1 group by lang
), frequent as (
  select * from counts where f >= 30
), candidates as (
  select lang, p, d, f as a from frequent where d > 1
), cuts as (
  select c.lang, c.p, c.d, c.a, k, x.f as l, y.f as r, 2000000 * c.a::hugeint // (x.f + y.f) as score
  from (select *, unnest(range(1, d)) as k from candidates) c
  join frequent x on x.lang = c.lang and x.p = c.p[1:k] join frequent y on y.lang = c.lang and y.p = c.p[k + 1:]
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1
), inner_parts as (
  select lang, p[i:i + m - 1] as p, max(a) as longer
  from (select *, unnest(range(1, d - m + 2)) as i from (select *, unnest(range(2, d)) as m from candidates)) group by all
), ranked as (
  select lang, array_to_string(p, ' ') as phrase, a, l, r, score
  from lowest left join inner_parts using (lang, p) where longer is null or 100 * longer::hugeint < 80 * a::hugeint
), placed as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from ranked
)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from placed join totals using (lang) where rank <= 2000
"""


@query(OP13)
def op13_phrase_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


OP11 = """
with texts as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), lengths as (
  select row, doc_id, len(w) as n from texts where len(w) > 0
), facts as (
  select count(*)::bigint as docs, sum(n)::bigint as length from lengths
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as term
  from benchmark
), postings as (
  select row, term, count(*) as tf from (select row, unnest(w) as term from texts) where term in (select term from asked) group by all
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from postings, facts group by term, docs
), impacts as (
  select row, term, weight * (1000000000 * tf // (1000 * tf + 8 * (10 + (90 * n::hugeint * docs) // length))) as impact
  from postings join weights using (term) join lengths using (row), facts
), scores as (
  select item_id, doc_id, row, sum(impact) as score from asked join impacts using (term) join lengths using (row) group by all
)
select item_id, rank, doc_id, score::bigint as score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0) where rank <= 10
"""


@query(OP11)
def op11_lexical_search(spark, folder):
    index = lexical.build(table(spark, folder, "documents"))
    return lexical.search(index, table(spark, folder, "benchmark")).withColumnsRenamed({"query": "item_id", "id": "doc_id"})


OP12 = """
with whole as (
  select row_number() over () as row, vec_id, [floor(64 * x::double) for x in embedding] as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), products as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from products) where rank <= 20
"""


@query(OP12)
def op12_inner_product_search(spark, folder):
    # queries and candidates are rows: an id that repeats is asked by each of its rows and found by the others
    found = inner_products.search(table(spark, folder, "embeddings"), asked=F.col("vec_id") % 20 == 0, by_row=True)
    return found.withColumnsRenamed({"query": "query_id", "id": "vec_id"})
