"""Benchmark decontamination with suffix arrays over the training text.

The training documents are read in shards (one Arrow batch each). A shard's words become numbers (0: a word that no
item has, or the end of a document) and its suffixes are sorted. Every test suffix that starts a window of an item is then looked up by
binary search; the suffixes between its two bounds are its verbatim occurrences. Suffixes whose first two words start no window cannot
be an answer and are left out of the array. Sorting goes as deep as a window, the deepest that a search asks. How far a
match goes beyond its window is read off the neighbours of the training suffix in the sorted test suffixes.

A window is `window` consecutive item words; an item of fewer words, but not none, is one window.

The items are the query set. They are shipped in blocks of about BLOCK_WORDS words (an item is never split), each block a pass of its own over the
documents (no shuffle); between two passes the rows are written to the shared folder, so no task ever holds two blocks. A document needs no other document: nothing is shuffled.

Null text has no words; a null item id counts for hits but is not listed. Repeated documents stay repeated. Empty tables give empty
results (no items: nothing is hit). A very long text is searched whole, with the batch it is in. Other
columns are not read, and `remove` returns them unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import over_batches, quoted, utf8, whole_row, with_id
from tributary.session import cut, discard

WINDOW = 10
#: Item words of one block: some 100 MB on the driver and in each task.
BLOCK_WORDS = 500_000

#: Bytes to word bytes: digits, a-z and all of any other script; A-Z become a-z, the rest separates words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Sorted:
    """Suffixes in order, as columns of several words packed into one number each."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, depth: int, bits: int, rank: np.ndarray | None = None) -> None:
        per = 62 // bits
        columns = [pack(ids, starts, at, min(per, depth - at), per, bits) for at in range(0, depth, per)]
        order = np.lexsort(columns[::-1] if rank is None else [rank[starts]]) if len(starts) else np.zeros(0, np.int64)
        self.at = starts[order]
        self.columns = [c[order] for c in columns]

    def bound(self, wanted: list[np.ndarray], side: str) -> np.ndarray:
        """First place whose suffix is not below (left) or is above (right) each of the wanted rows."""
        low = np.zeros(len(wanted[0]), np.int64)
        high = np.full(len(wanted[0]), len(self.at), np.int64)
        for k, (have, want) in enumerate(zip(self.columns, wanted)):
            last = k == len(wanted) - 1
            first = bisect(have, want, low, high, right=last and side == "right")
            if last:
                return first
            low, high = first, bisect(have, want, low, high, right=True)
        return low


def pack(ids: np.ndarray, starts: np.ndarray, skip: int, take: int, per: int, bits: int) -> np.ndarray:
    out = np.zeros(len(starts), np.int64)
    for k in range(per):
        out <<= bits
        if k < take:
            at = starts + skip + k
            out |= np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], 0)
    return out


def bisect(have: np.ndarray, want: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each wanted value between its own bounds."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        value = have[np.minimum(middle, len(have) - 1)]
        up = open_ & ((value <= want) if right else (value < want))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)
    return low


def ranks(text: np.ndarray) -> np.ndarray:
    """Rank of every suffix in full order, by doubling the length compared; a suffix ends at a 0, equal ones share a rank."""
    rank = text.copy()
    ends = text == 0  # does a suffix end within the words compared so far?
    length = 1
    while length < len(text):
        after = np.where(ends[:-length], 0, rank[length:])
        after = np.r_[after, np.zeros(length, np.int64)]
        order = np.lexsort([after, rank])
        new = np.r_[False, (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])]
        ends = ends | np.r_[ends[length:], np.ones(length, bool)]
        rank[order] = np.cumsum(new)
        if ends.all():
            break
        length *= 2
    return rank


class Items:
    """The test suffixes of one block of items, ready to be searched for. All in arrays, about a hundred bytes for each word."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number, parts, lengths = self.vocabulary.setdefault, [], []
        for _, text in items:
            words = words_of(text)
            parts.append(np.array([number(w, len(self.vocabulary) + 1) for w in words] + [0], np.int64))
            lengths.append(len(words))
        self.ids = [name for name, _ in items]
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.text = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        del parts
        lengths = np.array(lengths, np.int64)
        begins = np.cumsum(lengths + 1) - lengths - 1
        # where windows start, of which item, and of how many words
        count = np.where(lengths > 0, np.maximum(lengths - window + 1, 1), 0)
        owner = np.repeat(np.arange(len(lengths)), count)
        starts = begins[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        sizes = np.minimum(window, lengths)[owner]
        columns = self.columns(starts, sizes, 0)
        order = np.lexsort([owner, sizes, *columns[::-1]])
        owner, starts, sizes = owner[order], starts[order], sizes[order]
        columns = [c[order] for c in columns]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in (*columns, sizes)])
        window_of = np.cumsum(new) - 1
        once = np.ones(len(order), bool)  # an item that has a window twice owns it once
        once[1:] = new[1:] | (owner[1:] != owner[:-1])
        self.owner = owner[once]
        self.first = np.searchsorted(window_of[once], np.arange(window_of[-1] + 2 if len(order) else 1))
        starts, self.sizes = starts[new], sizes[new]
        self.low, self.high = self.columns(starts, self.sizes, 0), self.columns(starts, self.sizes, (1 << self.bits) - 1)
        self.single = np.unique(self.text[starts[self.sizes == 1]])
        wide = starts[self.sizes > 1]
        self.pairs = np.unique((self.text[wide] << 32) | self.text[wide + 1]) if window > 1 else np.zeros(0, np.int64)
        # all test suffixes in full order, for the length of a match beyond its window
        self.suffixes = Sorted(self.text, np.flatnonzero(self.text), window, self.bits, ranks(self.text))

    def names(self, window: int) -> list[str]:
        """Ids of the items that have a window."""
        return [n for k in self.owner[self.first[window] : self.first[window + 1]].tolist() if (n := self.ids[k]) is not None]

    def columns(self, starts: np.ndarray, sizes: np.ndarray, fill: int) -> list[np.ndarray]:
        """The windows packed; `fill` stands behind the end of a short one."""
        per, out = 62 // self.bits, []
        for at in range(0, self.window, per):
            column = np.zeros(len(starts), np.int64)
            for k in range(at, at + per):
                column <<= self.bits
                if k < self.window:
                    column |= np.where(k < sizes, self.text[np.minimum(starts + k, max(len(self.text) - 1, 0))], fill)
            out.append(column)
        return out

    def shard(self, ids: np.ndarray) -> Sorted:
        """The suffix array of a shard, over the suffixes that may start a window."""
        after = np.r_[ids[1:], 0]
        known = np.flatnonzero(ids)
        pair = (ids[known] << 32) | after[known]
        hit = np.isin(ids[known], self.single)
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            hit |= self.pairs[place] == pair
        return Sorted(ids, known[hit], self.window, self.bits)

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the shard, number of the window) of every occurrence."""
        if not len(self.sizes) or not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        array = self.shard(ids)
        first, last = array.bound(self.low, "left"), array.bound(self.high, "right")
        count = last - first
        which = np.repeat(np.arange(len(count)), count)
        place = array.at[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[which]]
        return place, which

    def reach(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Words from each place on that some item has verbatim: the longer match with the two neighbours in the order of all test suffixes."""
        if not len(places):
            return places
        per, at = 62 // self.bits, self.suffixes.at
        wanted = [pack(ids, places, k, min(per, self.window - k), per, self.bits) for k in range(0, self.window, per)]
        low, high = self.suffixes.bound(wanted, "left"), self.suffixes.bound(wanted, "right")
        while len(live := np.flatnonzero(low < high)):  # among equal windows, by the words behind them
            middle = (low[live] + high[live]) >> 1
            here, there = places[live], at[middle]
            same = self.common(ids, here, there)
            after = here + same
            wants = np.where(after < len(ids), ids[np.minimum(after, len(ids) - 1)], 0)
            up = self.text[there + same] < wants
            low[live] = np.where(up, middle + 1, low[live])
            high[live] = np.where(up, high[live], middle)
        before, behind = at[np.maximum(low - 1, 0)], at[np.minimum(low, len(at) - 1)]
        return np.maximum(self.common(ids, places, before), self.common(ids, places, behind))

    def common(self, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        length, live = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(live):
            x, y = a[live] + length[live], b[live] + length[live]
            same = (x < len(ids)) & (y < len(self.text))
            same[same] = ids[x[same]] == self.text[y[same]]
            same[same] = ids[x[same]] > 0
            live = live[same]
            length[live] += 1
        return length


SPANS = "array<struct<first:int,last:int>>"


class Search:
    """For each document: words, merged spans of hit words, longest match, ids of the items found."""

    def __init__(self, items, first: bool) -> None:
        self.items, self.first = items, first

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        items = self.items.value
        get, parts, sizes = items.vocabulary.get, [], []
        for text in batch.column(1):
            words = words_of(text.as_py())
            sizes.append(len(words))
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
            parts.append(np.zeros(1, np.int64))
        ids, sizes = np.concatenate(parts), np.array(sizes, np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        place, which = items.occurrences(ids)
        change = np.zeros(len(ids) + 1, np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + items.sizes[which], -1)
        longest = np.zeros(len(sizes), np.int64)
        names: list[set] = [set() for _ in sizes]
        if not self.first:
            longest = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            names = [set(x) for x in batch.column(4).to_pylist()]
            for at, spans in zip(starts, batch.column(2).to_pylist()):
                for span in spans:
                    change[at + span["first"]] += 1
                    change[at + span["last"] + 1] -= 1
        doc = np.searchsorted(starts, place, side="right") - 1
        for d, w in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
            names[d].update(items.names(w))
        np.maximum.at(longest, doc, items.reach(ids, place))
        hit = np.cumsum(change)[:-1] > 0
        edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        owner = np.searchsorted(starts, first, side="right") - 1
        spans: list[list] = [[] for _ in sizes]
        for d, a, b in zip(owner.tolist(), (first - starts[owner]).tolist(), (last - starts[owner]).tolist()):
            spans[d].append({"first": a, "last": b})
        yield {
            "id": batch.column(0), "t": batch.column(1), "n_words": sizes, "spans": spans, "longest": longest,
            "items": [sorted(n) for n in names],
        }


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[tuple[list, bool]]:
    """(different items, is it the last) in blocks of bounded size, each read by its own job."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), utf8(text_col).alias("t")).distinct()
    # a word has a byte and a separator at least, so bytes bound words
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    count = max(1, math.ceil(total / 2 / block_words))
    for k in range(count):
        some = items.where(F.pmod(F.xxhash64("id", "t"), F.lit(count)) == k) if count > 1 else items
        yield [(r["id"], bytes(r["t"])) for r in some.toLocalIterator()], k == count - 1


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, spans (first and last hit word), longest (words of the longest
    verbatim match that holds a whole window), items (ids as strings, in order)."""
    spark = docs.sparkSession
    out = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t"))
    for k, (block, last) in enumerate(blocks_of(benchmark, item_col, item_text_col, block_words)):
        items = spark.sparkContext.broadcast(Items(block, window))
        given = out if k == 0 else out.select("id", "t", "spans", "longest", "items")
        text = "" if last else "t binary, "  # what a further block needs to read
        schema = with_id(docs, id_col, f"{text}n_words long, spans {SPANS}, longest long, items array<string>")
        before, out = out, over_batches(given, Search(items, k == 0), schema)
        if not last:  # else the searches of all blocks would run at once, in one stage
            out = cut(out)
            discard(before)
    return out


def hits(spans: str = "spans"):
    """Hit words of a document."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    given = docs.select(whole_row(docs).alias("row"), F.col(quoted(text_col)).alias("text"))
    found = find(given, benchmark, "row", "text", **options)
    return found.where(F.size("spans") == 0).select("id.*")
