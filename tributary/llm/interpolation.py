"""Language-model scores by deleted interpolation of word bigrams.

A token's probability mixes three estimates: its relative frequency after the word before it, its relative frequency at all, and one share for each
word of the vocabulary and the unknown one. The weights of the mixture depend on how often the context was seen (its
binary logarithm is the bucket). They are learned by expectation maximisation: one fold of the training documents is deleted from the counts and
its tokens are the held-out events. Scores then use the counts of all training documents.

How it runs. Documents become slices of bounded size (sorted hashes of the slice's distinct words, and the tokens as places in them). Each
slice sends its distinct words and word pairs with their counts to buckets of the hash range, once each, as sorted arrays. A bucket adds
them up and answers every slice in the slice's own order, so frequent words are pre-added everywhere and nothing is keyed by a
word alone. Slices and answers are written to the shared folder. Held-out events are pooled over all slices on a logarithmic
grid of 1/16 octave; only that pool, whose size does not depend on the corpus, comes to the driver.

Words are told apart by 64 bits of XXH64, pairs by 64 bits mixed from them. Tokens: lower-cased (A-Z) words, then one end. The end also
stands before the first word as its context. Null text is empty: the end alone. Null ids are held out (they count as the empty text). Repeated
rows are learned from as often as they occur. An empty table gives an empty result; without any training document every token has probability 1 / 1.
A very long text is a slice of its own. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import arrow_schema, as_batch, fold_bucket, lower_words, over_batches, runs, utf8
from tributary.session import cut

#: Tokens of a slice (a longer document is a slice of its own) and tokens per bucket.
SLICE, BUCKET = 1 << 20, 1 << 22
#: Folds by crc32 of the id; documents of fold 0 are held out of training, those of fold 1 are deleted for learning the weights.
FOLDS, DELETED = 10, 1
#: Steps per octave of the grid for probabilities, and what stands for probability zero there.
GRID, NEVER = 16, -(1 << 20)
EM_STEPS = 200
#: Weights of a bucket without events, and how many events the pooled weights count for in each bucket.
DEFAULT, PRIOR = (0.3, 0.6, 0.1), 10.0
LEAST_SHARE = 1e-6

#: A blank is never a word.
END = np.uint64(xxhash.xxh64_intdigest(b" "))


# --- arrays as bytes -------------------------------------------------------


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned 64-bit numbers as one blob; byte planes, since high bytes are mostly zero."""
    planes = [len(a).to_bytes(8, "little") + np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        planes = np.frombuffer(data, np.uint8, 8 * n, at + 8).reshape(8, n)
        out.append(np.ascontiguousarray(planes.T).view("<u8").ravel())
        at += 8 + 8 * n
    return out


def steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, and back by a running sum."""
    return np.diff(keys, prepend=np.uint64(0))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key of 64 bits for each pair of keys."""
    k = a * np.uint64(0x9E3779B97F4A7C15) + b
    k ^= k >> np.uint64(32)
    k *= np.uint64(0xD6E8FEB86659FD93)
    k ^= k >> np.uint64(29)
    return k


# --- slices ----------------------------------------------------------------


class Slices:
    def __init__(self, schema: pa.Schema, size: int) -> None:
        self.schema, self.size = schema, size

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        self.next = TaskContext.get().partitionId() << 32
        self.clear()
        for batch in batches:
            for i, (text, fold) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                words = lower_words(text.as_py())
                if self.held and self.held + len(words) + 1 > self.size:
                    self.ids.append(batch.column(0).slice(self.first, i - self.first))
                    yield self.out()
                    self.first = i
                self.tokens.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
                self.tokens.append(np.zeros(1, np.uint32))  # the end is word 0
                self.held += len(words) + 1
                self.ends.append(self.held)
                self.folds.append(fold)
            self.ids.append(batch.column(0).slice(self.first))
            self.first = 0
        if self.held:
            yield self.out()

    def clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[b" "]  # noqa: B018  the end
        self.tokens, self.ends, self.folds, self.ids, self.held, self.first = [], [], [], [], 0, 0

    def out(self) -> pa.RecordBatch:
        words = np.array([xxhash.xxh64_intdigest(w) for w in self.number], np.uint64)
        order = np.argsort(words)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        tokens = place[np.concatenate(self.tokens)]
        planes = np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 4).T).tobytes()
        ids = pa.concat_arrays([x for x in self.ids if len(x)])
        row = {
            "slice": [self.next], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "folds": [self.folds], "ends": [np.array(self.ends, "<i8").tobytes()], "n": [self.held],
            "words": [squeeze(steps(words[order]))], "tokens": [zstandard.ZstdCompressor(level=1).compress(planes)],
        }
        self.next += 1
        self.clear()
        return as_batch(row, self.schema)


def slices(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"slice long, ids array<{kind}>, folds array<int>, ends binary, n long, words binary, tokens binary"
    given = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t"), fold_bucket(id_col, FOLDS).cast("int").alias("fold"))
    return given.mapInArrow(Slices(arrow_schema(docs, schema), size), schema)


class Slice:
    """A row of the table, unfolded."""

    def __init__(self, row: dict) -> None:
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.starts = np.r_[0, self.ends[:-1]]
        self.words = np.cumsum(unsqueeze(row["words"])[0], dtype=np.uint64)
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["tokens"]), np.uint8).reshape(4, -1)
        self.tokens = np.ascontiguousarray(planes.T).view("<i4").ravel()
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.starts] = np.searchsorted(self.words, END)
        self.fold = np.repeat(np.array(row["folds"], np.int8), self.ends - self.starts)
        self.pairs, pair = np.unique(mixed(self.words[self.before], self.words[self.tokens]), return_inverse=True)
        self.pair = pair.astype(np.int32)


def counts_of(places: np.ndarray, fold: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each kind occurs in training documents that are not deleted, and in deleted ones."""
    stays = np.bincount(places[(fold != 0) & (fold != DELETED)], minlength=kinds)
    return stays.astype(np.uint64), np.bincount(places[fold == DELETED], minlength=kinds).astype(np.uint64)


class Send:
    """A slice's distinct words and pairs with their counts, a row per bucket."""

    def __init__(self, bits: int) -> None:
        self.bits = bits

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        for row in rows_of(batch):
            it, sides = Slice(row), []
            for keys, places in ((it.words, it.tokens), (it.pairs, it.pair)):
                shift = np.uint64(64 - self.bits)
                at = np.searchsorted(keys >> shift, np.arange((1 << self.bits) + 1)) if self.bits else np.array([0, len(keys)])
                sides.append((at, (keys, *counts_of(places, it.fold, len(keys)))))
            blobs = [
                squeeze(*[x for at, arrays in sides for x in part(arrays, at[b], at[b + 1])]) for b in range(1 << self.bits)
            ]
            yield {"bucket": list(range(len(blobs))), "slice": [row["slice"]] * len(blobs), "counts": blobs}
            pa.default_memory_pool().release_unused()


def part(arrays: tuple, a: int, b: int) -> tuple:
    return (steps(arrays[0][a:b]), arrays[1][a:b], arrays[2][a:b])


def rows_of(batch) -> Iterator[dict]:
    """One row at a time, as Python values."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def add_up(table: pa.Table) -> pa.Table:
    """The rows of one bucket, from all slices: their counts become totals over the corpus, in the slice's order."""
    sent = [unsqueeze(b.as_py()) for b in table.column("counts")]
    sizes, answers, facts = [], [], []
    for side in (0, 3):
        keys = np.concatenate([np.cumsum(s[side], dtype=np.uint64) for s in sent])
        order = np.argsort(keys, kind="stable")
        first, length = runs(keys[order])
        both = []
        for k in (1, 2):
            total = np.add.reduceat(np.concatenate([s[side + k] for s in sent])[order], first) if len(first) else np.zeros(0, np.uint64)
            back = np.empty(len(keys), np.uint64)
            back[order] = np.repeat(total, length)
            both.append((total, back))
        facts += [int(((both[0][0] + both[1][0]) > 0).sum()), int(both[0][0].sum()), int(both[1][0].sum())]
        sizes.append(np.cumsum([0, *[len(s[side]) for s in sent]]))
        answers.append((both[0][1], both[1][1]))
    blobs = [
        squeeze(*[x[n[k] : n[k + 1]] for n, pair in zip(sizes, answers) for x in pair]) for k in range(len(sent))
    ]
    once = [[f] + [0] * (len(sent) - 1) for f in facts[:3]]  # of words; the bucket says it once
    return pa.table({
        "slice": table.column("slice"), "bucket": table.column("bucket"), "totals": pa.array(blobs, pa.binary()),
        "kinds": pa.array(once[0], pa.int64()), "stays": pa.array(once[1], pa.int64()), "deleted": pa.array(once[2], pa.int64()),
    })


def totals_of(right: pa.Table) -> list[np.ndarray]:
    """Totals of a slice's words (stays, deleted) and pairs (stays, deleted), over all buckets."""
    parts = [unsqueeze(b.as_py()) for b in right.sort_by("bucket").column("totals")]
    return [np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(4)]


# --- weights ---------------------------------------------------------------


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the binary logarithm."""
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))).astype(np.int64), 0)


def on_grid(top: np.ndarray, below: np.ndarray) -> np.ndarray:
    ratio = np.log2(np.maximum(top, 1) / np.maximum(below, 1))
    return np.where(top > 0, np.rint(GRID * ratio), NEVER).astype(np.int64)


def learn(events: np.ndarray, kinds: int) -> np.ndarray:
    """Weights (pair, word, share) by bucket from rows (bucket, pair on grid, word on grid, how many)."""
    if not len(events):
        weights = np.tile(np.array(DEFAULT), (65, 1))
    else:
        p = np.stack([np.where(events[:, k] == NEVER, 0.0, 2.0 ** (events[:, k] / GRID)) for k in (1, 2)], axis=1)
        p = np.hstack([p, np.full((len(p), 1), 1 / (kinds + 1))])
        n, at = events[:, 3].astype(float), events[:, 0]
        pooled = np.array(DEFAULT)
        for _ in range(EM_STEPS):
            share = p * pooled
            pooled = (share * (n / share.sum(axis=1))[:, None]).sum(axis=0) / n.sum()
        weights = np.tile(pooled, (65, 1))
        for _ in range(EM_STEPS):
            share = p * weights[at]
            share *= (n / share.sum(axis=1))[:, None]
            mass = np.stack([np.bincount(at, share[:, k], 65) for k in range(3)], axis=1) + PRIOR * pooled
            weights = mass / mass.sum(axis=1, keepdims=True)
    weights[0, 0] = 0.0  # nothing follows a context never seen
    weights = np.maximum(weights, [0.0, 0.0, LEAST_SHARE])
    return weights / weights.sum(axis=1, keepdims=True)


class Model:
    """What scores need beside the counts: weights, training tokens, distinct training words."""

    def __init__(self, weights: np.ndarray, tokens: int, kinds: int) -> None:
        self.weights, self.tokens, self.kinds = weights, tokens, kinds

    def probability(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of tokens, given the counts of the pair, of its context and of the word."""
        if not self.tokens:
            return np.ones(len(pair))
        w = self.weights[bucket(context)]
        return w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / self.tokens + w[:, 2] / (self.kinds + 1)

    def base(self, word: np.ndarray) -> np.ndarray:
        return np.log10((word + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))


# --- jobs ------------------------------------------------------------------


def counted(docs: DataFrame, id_col: str, text_col: str, size: int, per_bucket: int) -> tuple[DataFrame, DataFrame]:
    """(slices, the corpus totals of their words and pairs), both written."""
    parts = cut(slices(docs, id_col, text_col, size))
    tokens = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, tokens / per_bucket))))
    sent = over_batches(parts.select("slice", "folds", "ends", "words", "tokens"), Send(bits), "bucket long, slice long, counts binary")
    schema = "slice long, bucket long, totals binary, kinds long, stays long, deleted long"
    return parts, cut(sent.groupBy("bucket").applyInArrow(add_up, schema))


def model_of(parts: DataFrame, totals: DataFrame) -> Model:
    facts = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kinds", "stays", "deleted")]).first()
    kinds, stays = facts["kinds"], facts["stays"]

    def events(left: pa.Table, right: pa.Table) -> pa.Table:
        it, (word, _, pair, _) = Slice(left.to_pylist()[0]), totals_of(right)
        at = np.flatnonzero(it.fold == DELETED)
        context = word[it.before[at]]
        rows = np.stack([
            bucket(context), on_grid(pair[it.pair[at]], context),
            on_grid(word[it.tokens[at]], np.full(len(at), stays)),
        ], axis=1)
        found, n = np.unique(rows, axis=0, return_counts=True) if len(rows) else (rows, np.zeros(0, np.int64))
        return pa.table({"b": found[:, 0], "p": found[:, 1], "w": found[:, 2], "n": n.astype(np.int64)})

    pooled = join(parts, totals, events, "b long, p long, w long, n long").groupBy("b", "p", "w").agg(F.sum("n").alias("n"))
    got = pooled.orderBy("b", "p", "w").toPandas().to_numpy(np.int64)  # a cell of the grid each
    return Model(learn(got.reshape(-1, 4), kinds), stays + facts["deleted"], kinds)


def join(parts: DataFrame, totals: DataFrame, function, schema: str) -> DataFrame:
    left = parts.select("slice", "ids", "folds", "ends", "words", "tokens")
    return left.groupBy("slice").cogroup(totals.select("slice", "bucket", "totals").groupBy("slice")).applyInArrow(function, schema)


def scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SLICE, per_bucket: int = BUCKET
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability)."""
    kind = docs.schema[id_col].dataType.simpleString()
    parts, totals = counted(docs, id_col, text_col, size, per_bucket)
    model = model_of(parts, totals)
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    form = arrow_schema(docs, schema)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        it, (w_stays, w_deleted, p_stays, p_deleted) = Slice(left.to_pylist()[0]), totals_of(right)
        word, pair = w_stays + w_deleted, p_stays + p_deleted
        count = word[it.tokens]
        found = model.probability(pair[it.pair], word[it.before], count)
        ids = left.column("ids").combine_chunks().flatten()
        columns = {
            "id": ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids,
            "held_out": pa.array(np.array(left.column("folds")[0].as_py()) == 0), "n_tokens": it.ends - it.starts,
            "n_known": np.add.reduceat((count > 0).astype(np.int64), it.starts),
            "train_tokens": np.full(len(it.ends), model.tokens, np.int64),
            "base_score": np.add.reduceat(model.base(count), it.starts), "score": np.add.reduceat(np.log10(found), it.starts),
        }
        return pa.Table.from_batches([as_batch(columns, form)])

    return join(parts, totals, score, schema)
