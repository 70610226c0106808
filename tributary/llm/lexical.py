"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

`build` turns documents into shards of an inverted index, each of a bounded number of terms and written to the shared folder: documents in order of their
ids, their lengths, and for each term its postings (document, occurrences). `search` ranks all documents for each query. In a shard, the
query's short lists are added up term at a time. Their sums then act as one more iterator with a known bound, next to the long lists, and
documents are gone through in windows of ordinals: a window whose bounds together stay below the query's threshold is skipped
in all lists at once. In the others, only documents of the iterators that could lift a document to the threshold by themselves are candidates; they
are completed from the remaining lists, highest bound first, and dropped as soon as what is left cannot lift them. The threshold is the
lowest of the best scores so far and lives on from shard to shard of a task.

The weight of a term needs the number of documents that hold it, so a first pass over the terms of the shards counts those of the queries. A task hands
back the best documents of each query, and Spark ranks these. Queries are shipped in blocks of at most BLOCK different (query, term) pairs (a query alone
may have more, up to its own vocabulary), each block read by its own tasks; no text is ever shuffled.

With N documents that hold a term, L terms in them, n in one, df documents with a term and tf of them in one, a term weighs
w = floor(1000 ln((2N + 2) / (2 df + 1))), a document has m = 100 - b + b n N div L (b = 90), and it scores the sum of
w * (10^9 tf div (1000 tf + 8 m)) over the query's terms, once each. Only scores above 0 count.

Null text has no terms. Equal scores go by ascending id, null ids last. Repeated documents are documents of their own; rows of equal query id are one query with
the terms of all. Very long texts are shards of their own. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import arrow_schema, as_batch, over_batches, runs, utf8
from tributary.llm.decontaminate import words_of
from tributary.llm.interpolation import squeeze, steps, unsqueeze
from tributary.session import cut, discard

#: Terms of a shard, documents of a window, (query, term) pairs of a block.
SHARD, WINDOW, BLOCK = 1 << 21, 128, 200_000
#: A list is long if it holds this share of its shard's documents, and so many.
LONG_SHARE, LONG = 1 / 16, 256
#: The constants of the score: b, and what multiplies tf above and below.
B, ABOVE, BELOW = 90, 1_000_000_000, 1000


# --- index -----------------------------------------------------------------


class Shards:
    """Documents with a term become shards of at most `size` terms; a longer one is a shard of its own."""

    def __init__(self, schema: pa.Schema, size: int) -> None:
        self.schema, self.size = schema, size

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.clear()
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                if not words:
                    continue
                if self.held and self.held + len(words) > self.size:
                    yield self.out()
                    self.clear()
                self.terms.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
                self.ids.append(batch.column(0).slice(i, 1))
                self.held += len(words)
        if self.held:
            yield self.out()

    def clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.terms, self.ids, self.held = [], [], 0

    def out(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        order = pc.array_sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lengths = np.array([len(t) for t in self.terms], np.int64)
        keys = (np.concatenate(self.terms).astype(np.uint64) << np.uint64(32)) | np.repeat(place, lengths).astype(np.uint64)
        keys.sort()
        first, tf = runs(keys)
        df = np.bincount((keys[first] >> np.uint64(32)).astype(np.int64), minlength=len(self.number))
        row = {
            "n_docs": [len(ids)], "n_terms": [self.held], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
            "terms": [zstandard.ZstdCompressor(level=1).compress(b" ".join(self.number))], "dfs": [squeeze(df.astype(np.uint64))],
            "lengths": [squeeze(lengths[order].astype(np.uint64))], "postings": [squeeze(steps(keys[first]), tf.astype(np.uint64))],
        }
        pa.default_memory_pool().release_unused()
        return as_batch(row, self.schema)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_terms: int = SHARD) -> DataFrame:
    """The index of all documents, a row per shard, written to the shared folder. Ids may be numbers, texts or dates."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"n_docs long, n_terms long, ids array<{kind}>, terms binary, dfs binary, lengths binary, postings binary"
    given = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t"))
    return cut(given.mapInArrow(Shards(arrow_schema(docs, schema), shard_terms), schema))


# --- queries ---------------------------------------------------------------


class Queries:
    """A block of queries: ids, their terms as numbers, and the weights of the terms."""

    def __init__(self, pairs: list[tuple], kind: pa.DataType) -> None:
        self.number: dict[bytes, int] = {}
        terms = defaultdict(list)
        for name, term in pairs:
            terms[name].append(self.number.setdefault(term, len(self.number)))
        self.names = pa.array(list(terms), kind)
        self.terms = [np.unique(t) for t in terms.values()]
        self.weights = np.zeros(len(self.number), np.int64)
        self.docs = self.length = 0

    def weigh(self, docs: int, length: int, df: dict[int, int]) -> Queries:
        self.docs, self.length = docs, length
        for t in range(len(self.weights)):
            self.weights[t] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(t, 0) + 1)))
        return self

    def known(self, terms: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the queries' terms, their places among the shard's terms)."""
        words = zstandard.ZstdDecompressor().decompress(terms).split(b" ")
        numbers = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        places = np.flatnonzero(numbers >= 0)
        return numbers[places], places


class Holders:
    """How many documents of each shard hold a query term."""

    def __init__(self, queries) -> None:
        self.queries = queries

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        for terms, dfs in zip(batch.column(0), batch.column(1)):
            numbers, places = self.queries.value.known(terms.as_py())
            yield {"term": numbers, "df": unsqueeze(dfs.as_py())[0][places].astype(np.int64)}


# --- search ----------------------------------------------------------------


class Shard:
    """A row of the index, unfolded as far as a block of queries needs it."""

    def __init__(self, row: dict, queries: Queries) -> None:
        self.queries, self.n_docs = queries, row["n_docs"]
        lengths = unsqueeze(row["lengths"])[0].astype(np.int64)
        if B * int(lengths.max()) * queries.docs < 1 << 63:
            norm = B * lengths * queries.docs // queries.length
        else:
            norm = np.array([B * n * queries.docs // queries.length for n in lengths.tolist()], np.int64)
        self.norm = 100 - B + norm
        numbers, places = queries.known(row["terms"])
        df = unsqueeze(row["dfs"])[0].astype(np.int64)
        ends = np.cumsum(df)
        self.ranges = {t: (a, b) for t, a, b in zip(numbers.tolist(), (ends - df)[places].tolist(), ends[places].tolist())}
        keys, tf = unsqueeze(row["postings"])
        self.docs = (np.cumsum(keys, dtype=np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.tf = tf.astype(np.int64)
        self.edges = np.arange(0, self.n_docs + WINDOW, WINDOW)
        self.least = np.minimum.reduceat(self.norm, self.edges[:-1])
        self.long_from = max(LONG, LONG_SHARE * self.n_docs)
        self.short: dict[int, tuple] = {}
        self.long: dict[int, LongList] = {}

    def score(self, term: int, tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return self.queries.weights[term] * (ABOVE * tf // (BELOW * tf + 8 * norm))

    def short_list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in self.short:
            a, b = self.ranges[term]
            self.short[term] = self.docs[a:b], self.score(term, self.tf[a:b], self.norm[self.docs[a:b]])
        return self.short[term]

    def long_list(self, term: int) -> LongList:
        if term not in self.long:
            self.long[term] = LongList(self, term, *self.ranges[term])
        return self.long[term]

    def is_long(self, term: int) -> bool:
        a, b = self.ranges[term]
        return b - a >= self.long_from


class LongList:
    """Postings in windows, with a bound for each window from its highest tf and its shortest document; scored only where looked at."""

    def __init__(self, shard: Shard, term: int, a: int, b: int) -> None:
        self.shard, self.term, self.docs, self.tf = shard, term, shard.docs[a:b], shard.tf[a:b]
        self.starts = np.searchsorted(self.docs, shard.edges)
        full = np.flatnonzero(self.starts[1:] > self.starts[:-1])
        self.bound = np.zeros(len(shard.least), np.int64)
        self.bound[full] = shard.score(term, np.maximum.reduceat(self.tf, self.starts[full]), shard.least[full])

    def window(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[w], self.starts[w + 1]
        docs = self.docs[a:b]
        return docs, self.shard.score(self.term, self.tf[a:b], self.shard.norm[docs])

    def at(self, w: int, docs: np.ndarray) -> np.ndarray:
        """Scores of the given documents of a window."""
        a, b = self.starts[w], self.starts[w + 1]
        out = np.zeros(len(docs), np.int64)
        if b > a:
            place = np.minimum(a + np.searchsorted(self.docs[a:b], docs), b - 1)
            same = self.docs[place] == docs
            out[same] = self.shard.score(self.term, self.tf[place[same]], self.shard.norm[docs[same]])
        return out


class Sums:
    """The short lists of a query, added up: one iterator with bounds like a long list."""

    def __init__(self, shard: Shard, terms: list[int]) -> None:
        lists = [shard.short_list(t) for t in terms]
        docs = np.concatenate([x for x, _ in lists]) if lists else np.zeros(0, np.int64)
        total = np.zeros(shard.n_docs, np.int64)
        for some, scores in lists:
            total[some] += scores
        self.docs = np.unique(docs)
        self.total = total[self.docs]
        self.starts = np.searchsorted(self.docs, shard.edges)
        self.bound = np.zeros(len(shard.least), np.int64)
        full = np.flatnonzero(self.starts[1:] > self.starts[:-1])
        if len(full):
            self.bound[full] = np.maximum.reduceat(self.total, self.starts[full])

    def window(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[w], self.starts[w + 1]
        return self.docs[a:b], self.total[a:b]

    def at(self, w: int, docs: np.ndarray) -> np.ndarray:
        some, scores = self.window(w)
        out = np.zeros(len(docs), np.int64)
        if len(some):
            place = np.minimum(np.searchsorted(some, docs), len(some) - 1)
            same = some[place] == docs
            out[same] = scores[place[same]]
        return out


class Best:
    """The k best (score, id) of a query so far."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    @property
    def threshold(self) -> int:
        """Lower scores cannot enter any more; an equal one can by its id."""
        return self.rows[-1][3] if len(self.rows) == self.k else 1

    def add(self, scores: list[int], ids: list) -> None:
        new = [(-s, i is None, i, s) for s, i in zip(scores, ids)]
        # a null id never meets another id in a comparison
        self.rows = sorted(self.rows + new, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))[: self.k]


class Search:
    def __init__(self, queries, k: int, schema: pa.Schema) -> None:
        self.queries, self.k, self.schema = queries, k, schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = self.queries.value
        best = [Best(self.k) for _ in queries.terms]
        for batch in batches:
            ids = batch.column("ids")
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("n_docs", "terms", "dfs", "lengths", "postings")}
                shard = Shard(row, queries)
                for terms, top in zip(queries.terms, best):
                    look(shard, [t for t in terms.tolist() if t in shard.ranges], top, ids[i].values)
                del shard, row
            pa.default_memory_pool().release_unused()
        places = [q for q, top in enumerate(best) for _ in top.rows]
        if places:
            yield as_batch({
                "query": queries.names.take(pa.array(places)), "id": [r[2] for top in best for r in top.rows], "score": [r[3] for top in best for r in top.rows],
            }, self.schema)


def look(shard: Shard, terms: list[int], top: Best, ids: pa.Array) -> None:
    """Go through the windows of a shard for one query."""
    if not terms:
        return
    lists = [shard.long_list(t) for t in terms if shard.is_long(t)]
    lists.append(Sums(shard, [t for t in terms if not shard.is_long(t)]))
    bounds = np.stack([x.bound for x in lists])
    total = bounds.sum(axis=0)
    for w in np.flatnonzero(total >= top.threshold).tolist():
        threshold = top.threshold
        if total[w] < threshold:
            continue
        order = np.argsort(-bounds[:, w], kind="stable").tolist()
        rest = np.cumsum(bounds[order[::-1], w])[::-1].tolist() + [0]  # bound of this list and all after it
        needed = next(k for k in range(len(rest)) if rest[k] < threshold)  # what is only in later lists stays below
        first = w * WINDOW
        sums = np.zeros(min(WINDOW, shard.n_docs - first), np.int64)
        met = np.zeros(len(sums), bool)
        for k in order[:needed]:
            docs, scores = lists[k].window(w)
            sums[docs - first] += scores
            met[docs - first] = True
        docs = np.flatnonzero(met)
        for k in range(needed, len(order)):
            docs = docs[sums[docs] + rest[k] >= threshold]
            if not len(docs):
                break
            sums[docs] += lists[order[k]].at(w, docs + first)
        docs = docs[sums[docs] >= threshold]
        if len(docs):
            if len(docs) > top.k:  # ordinals follow the ids, so a stable sort settles ties
                docs = docs[np.argsort(-sums[docs], kind="stable")[: top.k]]
            top.add(sums[docs].tolist(), ids.take(pa.array(docs + first)).to_pylist())


def blocks_of(queries: DataFrame, id_col: str, text_col: str, pairs: int) -> Iterator[tuple[list[tuple], pa.DataType]]:
    """Different (query, term) pairs in blocks of bounded size; all of a query in one."""
    kind = queries.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, term binary"

    def terms(batch: pa.RecordBatch) -> Iterator[dict]:
        for k in range(batch.num_rows):
            words = list(dict.fromkeys(words_of(batch.column(1)[k].as_py())))
            yield {"id": batch.column(0).take(pa.array([k] * len(words), pa.int64())), "term": words}

    each = cut(over_batches(queries.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")), terms, schema).distinct())
    count = max(1, math.ceil(each.count() / pairs))
    for k in range(count):
        some = each.where(F.pmod(F.xxhash64("id"), F.lit(count)) == k).orderBy("id", "term").collect()
        yield [(r["id"], bytes(r["term"])) for r in some], arrow_schema(queries, schema).field("id").type
    discard(each)


def search(
    index: DataFrame, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10, block_pairs: int = BLOCK
) -> DataFrame:
    """The k best documents of each query: query, rank (from 1), id, score."""
    spark = index.sparkSession
    facts = index.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_docs", "n_terms")]).first()
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"query {queries.schema[id_col].dataType.simpleString()}, id {doc_kind}, score long"
    found = spark.createDataFrame([], schema)
    for pairs, kind in blocks_of(queries, id_col, text_col, block_pairs):
        if not pairs or not facts["n_terms"]:
            continue
        block = Queries(pairs, kind)
        given = spark.sparkContext.broadcast(block)
        counted = over_batches(index.select("terms", "dfs"), Holders(given), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = {r["term"]: r["df"] for r in counted.collect()}
        given.destroy()
        weighed = spark.sparkContext.broadcast(block.weigh(facts["n_docs"], facts["n_terms"], df))
        some = index.mapInArrow(Search(weighed, k, arrow_schema(index, schema)), schema)
        found = found.unionByName(some)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "id", "score")
