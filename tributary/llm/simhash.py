"""Near-duplicates by SimHash, found through the anchors of a covering code.

A document's fingerprint has 64 bits: a bit is set when it is set in over half the hashes of its word shingles. Two fingerprints
link when at most three bits differ, so in one of their halves at most one differs. Each half of 32 bits is covered by anchors: the
codewords of the Hamming code of length 31, with the last bit free. The code's covering radius is 1, so each half lies within 1 of some
anchor, and a half one bit away lies within 2 of it. Every fingerprint is copied to all anchors within 1 + 1 of each half (17
at most), and only fingerprints that share an anchor are compared. No link is lost; most anchors hold a single fingerprint.

Exact copies have one fingerprint and meet the anchors as one row. An anchor with many fingerprints is cut into blocks, and
each pair of blocks is a task of its own. What leaves a comparison is a forest (a link less than rows), never all pairs.

Null or empty text: fingerprint zero, which links like any other. Null ids keep their row; the smallest id ignores them. Repeated rows
stay repeated. A very long text is hashed in runs of 65,536 shingles; a bit set in exactly half of the hashes is 0. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import arrow_schema, as_batch, hashable, lower_words, over_batches, quoted, runs, utf8, whole_row
from tributary.operators.skew import spread_join
from tributary.session import cut, discard

BITS = 64
#: Differing bits that still link. The code below is built for this value.
DISTANCE = 3
#: Fingerprints of one anchor that are compared in one go.
BLOCK = 4096
SEED = 42


# --- fingerprints ----------------------------------------------------------


def fingerprint(text: bytes, shingle: int) -> int:
    words = lower_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.r_[0, ends[:-1] + 1][: len(words) - size + 1].tolist()
    last = ends[size - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, len(first)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, 1 << 16):
        some = zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)])
        hashes = np.array([digest(line[a:b], SEED) for a, b in some], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per document: id, fingerprint (the 64 bits as a signed long)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
        yield {"id": batch.column(0), "fingerprint": pa.array(prints, pa.int64())}

    return over_batches(docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")), run, f"id {kind}, fingerprint long")


# --- anchors ---------------------------------------------------------------


def syndromes() -> list[np.ndarray]:
    """By byte of a 31-bit half: the exclusive or of the positions 1..31 of its set bits."""
    tables = []
    for byte in range(4):
        table = np.zeros(256, np.int64)
        for bit in range(8):
            if (at := 8 * byte + bit) < 31:
                table[(np.arange(256) >> bit) & 1 == 1] ^= at + 1
        tables.append(table)
    return tables


TABLES = syndromes()
#: For a syndrome, the masks that turn the half into the codewords one and two flips away.
FLIPS = [
    [0] if s == 0 else [1 << (s - 1)] + [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < (i ^ s)]
    for s in range(32)
]


def anchors_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor): all anchors within two flips of either half."""
    rows, keys = [], []
    for half in range(2):
        word = (prints.view(np.uint64) >> np.uint64(32 * half)).astype(np.int64) & 0xFFFFFFFF
        code, free = word & 0x7FFFFFFF, word >> 31
        syndrome = np.zeros(len(word), np.int64)
        for byte in range(4):
            syndrome ^= TABLES[byte][(code >> (8 * byte)) & 255]
        for s in np.unique(syndrome):
            at = np.flatnonzero(syndrome == s)
            for k, mask in enumerate(FLIPS[s]):
                near = code[at] ^ mask
                rows.append(at)
                keys.append((half << 32) | (free[at] << 31) | near)
                if k == 0:  # one flip at most so far: the free bit may differ too
                    rows.append(at)
                    keys.append((half << 32) | ((1 - free[at]) << 31) | near)
    return np.concatenate(rows), np.concatenate(keys)


def at_anchors(prints: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(values), 4096):
            rows, keys = anchors_of(some := values[at : at + 4096])
            yield {"anchor": pa.array(keys), "fingerprint": pa.array(some[rows])}

    return over_batches(prints.select("fingerprint"), run, "anchor long, fingerprint long")


# --- comparing -------------------------------------------------------------


def forest(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal key that differ in few bits, as (fingerprint, root of its tree).

    Row i is held against row i + step for growing steps, over those keys
    that have so many rows; only links that join two trees are kept.
    """
    parent = np.arange(len(keys))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    starts, sizes = runs(keys)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(keys)) - 1  # rows of the same key that follow
    live, step = np.flatnonzero(left >= 1), 1
    while len(live):
        differ = np.bitwise_count((prints[live] ^ prints[live + step]).view(np.uint64))  # of signed numbers it counts the absolute value
        close = live[(differ <= DISTANCE) & (prints[live] != prints[live + step])]
        close = close[parent[close] != parent[close + step]]
        for i in close.tolist():
            a, b = root(i), root(i + step)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(close):
            while (parent != (up := parent[parent])).any():
                parent = up
        step += 1
        live = live[left[live] >= step]
    linked = np.flatnonzero(parent != np.arange(len(keys)))
    return prints[linked], prints[parent[linked]]


class Compare:
    """Reads rows in key order; a key that goes on in the next batch is kept back."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            keys = np.vstack([keys, np.stack(new[:3], axis=1)])
            prints = np.r_[prints, new[3]]
            whole = len(keys) - int(np.argmax((keys[::-1] != keys[-1]).any(axis=1))) if len(keys) and (keys != keys[-1]).any() else 0
            yield from self.links(keys[:whole], prints[:whole])
            keys, prints = keys[whole:], prints[whole:]
        yield from self.links(keys, prints)

    def links(self, keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys) > 1:
            group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)])
            a, b = forest(group, prints)
            if len(a):
                yield as_batch({"a": pa.array(a), "b": pa.array(b)}, self.schema)


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints that together connect all pairs within three bits."""
    anchored = at_anchors(prints)
    crowded = cut(
        anchored.groupBy("anchor").agg(F.count("*").alias("rows")).where(F.col("rows") > block)
        .select("anchor", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("fingerprint"), F.coalesce("blocks", F.lit(1))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    dealt = (
        anchored.join(crowded, "anchor", "left").withColumn("mine", mine).withColumn("other", others)
        .select("anchor", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fingerprint")
    )
    grouped = dealt.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    schema = "a long, b long"
    return grouped.mapInArrow(Compare(arrow_schema(prints, schema)), schema)


# --- groups ----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link.

    Alternates large-star and small-star steps until no link changes; each step
    is written to the shared folder, so a lost executor costs one step.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join reads two plain sides and Spark can split a hub's links
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, now = now, cut(low.select("a", F.col("m").alias("b")).unionByName(rest).distinct())
        discard(before, least)
        if (then := state(now)) == seen:
            break
        seen = then
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, block: int = BLOCK
) -> DataFrame:
    """One row per document: id, fingerprint (long), component (the smallest id reachable over links)."""
    printed = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = printed.groupBy("fingerprint").agg(F.min("id").alias("first"))
    roots = components(links(distinct, block))
    placed = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = placed.groupBy("root").agg(F.min("first").alias("component"))
    named = placed.join(least, "root").select("fingerprint", "component")
    return spread_join(printed, cut(named), "fingerprint").select("id", "fingerprint", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows are told apart by two hashes over all columns (128 bits); equal rows
    are merged within each task before anything is shuffled, so a third of the rows being copies of one does
    no harm. Null ids come first.
    """
    others = [f for f in docs.schema if f.name != id_col]
    whole = F.struct(F.col(quoted(id_col)), *[hashable(F.col(quoted(f.name)), f.dataType) for f in others])
    keyed = docs.select(
        whole_row(docs).alias("row"), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"),
        F.xxhash64(whole).alias("h"), F.xxhash64(F.lit(1), whole).alias("g"),
    )
    named = near_duplicates(keyed.select(F.struct("id", "h", "g").alias("key"), "text"), "key", "text", shingle)
    stay = named.select("component.h", "component.g").distinct()
    return keyed.select("row", "h", "g").dropDuplicates(["h", "g"]).join(stay, ["h", "g"]).select("row.*")


def hexadecimal(column: str):
    """A signed long as 16 lower-case hex digits of its 64 bits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
