"""Phrase collocations by vertical partitioning of word prefixes.

A phrase is two to four consecutive words of a piece of text (pieces end at punctuation and line ends); everything is counted per language.
The suffixes of all pieces, cut off after four words, form a forest of word trees, and a phrase's frequency is the sum of the leaves
below its node. The forest is cut vertically: prefixes are put into groups whose suffixes fit a memory budget, and each group
builds its subtrees on its own.

How it runs. Documents become slices of bounded size (the slice's distinct words, and the tokens as places among them), written to the shared
folder. Words are counted; those with at least `least` occurrences are numbered by falling frequency, because no phrase with a rarer word can
reach `least`, so a suffix also ends before one. Each slice gets the numbers of its words back and is written once more, as numbers. Running totals of the frequencies deal the words out to groups. A word with more
suffixes than a group should hold is extended: its suffixes are dealt by the next word, and so are its hot pairs and
triples, which a fixed stride of the suffixes finds. Each slice then adds up its equal suffixes, sorted, and sends each group that it has suffixes for one
blob. A group merges its blobs and reads the counts of all nodes from the leaf totals. Nothing is keyed by a word alone, and a passage
that many documents share arrives once for each slice.

The plan of extended prefixes is the only thing shipped to all tasks. It has at most PLAN prefixes of each length: beyond PLAN * budget / 2
suffixes the budget grows with the corpus instead.

Candidates are phrases of at least `least` occurrences. Each cut of a candidate into a first part and a rest, with frequencies l and r, scores
floor(2000000 * a / (l + r)); the lowest cut counts, the earliest of equals. A candidate whose words lie inside a longer candidate that
has at least 80 of 100 of its occurrences is dropped.

Null text is empty, null language is `und`. Repeated rows count as often as they occur. Ties fall to the smaller phrase (bytes), so the
order is total. Very long texts are one slice each. Empty tables give an empty result. Other columns are not read. At most 2^31 words of a corpus may reach `least`.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import arrow_schema, as_batch, over_batches, runs, utf8
from tributary.llm.interpolation import squeeze, steps, unsqueeze
from tributary.operators.skew import spread_join
from tributary.session import cut, discard

#: Words of a slice; suffixes of a group; longest phrase; extended prefixes of one length.
SLICE, BUDGET, DEPTH, PLAN = 1 << 21, 1 << 21, 4, 1 << 17
#: Every so many suffixes of a slice are looked at to find hot pairs and triples.
STRIDE = 64
LEAST = 30
#: Score of a phrase that always occurs as a whole, over two; share of a longer phrase that makes a part of it drop out, in hundredths.
SCALE, INSIDE = 2_000_000, 80
KEYS = ["a", "b", "c", "d"]

#: Bytes to bytes: A-Z become a-z, what ends a piece becomes a full stop, a tab becomes a blank.
FOLD = bytes(
    ord(".") if x in b".,;:!?\n\x0b\x0c\r" else ord(" ") if x == 9 else x + 32 if 65 <= x <= 90 else x for x in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words in order, a full stop where a piece ends. No word holds one."""
    return text.translate(FOLD).replace(b".", b" . ").split()


# --- slices ----------------------------------------------------------------


class Open:
    """A slice of one language while documents are added to it. Number 0 ends a piece."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[b"."]  # noqa: B018
        self.tokens: list[np.ndarray] = []

    def add(self, words: list[bytes]) -> None:
        self.tokens.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
        self.tokens.append(np.zeros(1, np.uint32))


class Slices:
    def __init__(self, schema: pa.Schema, size: int) -> None:
        self.schema, self.size = schema, size

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        self.next = TaskContext.get().partitionId() << 32
        held, slices = 0, defaultdict(Open)
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                if held and held + len(words) > self.size:
                    yield from self.out(slices)
                    held, slices = 0, defaultdict(Open)
                slices[lang].add(words)
                held += len(words) + 1
        yield from self.out(slices)

    def out(self, slices: dict[str, Open]) -> Iterator[pa.RecordBatch]:
        for lang, it in slices.items():
            tokens = np.concatenate(it.tokens)
            counts = np.bincount(tokens, minlength=len(it.number))[1:]
            planes = np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 4).T).tobytes()
            yield as_batch({
                "slice": [self.next], "lang": [lang], "n": [int(counts.sum())], "words": [list(it.number)[1:]], "counts": [counts],
                "tokens": [zstandard.ZstdCompressor(level=1).compress(planes)],
            }, self.schema)
            self.next += 1
        pa.default_memory_pool().release_unused()


def slices_of(docs: DataFrame, text_col: str, lang_col: str, size: int) -> DataFrame:
    schema = "slice long, lang string, n long, words array<binary>, counts array<long>, tokens binary"
    given = docs.select(utf8(text_col), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")))
    return given.mapInArrow(Slices(arrow_schema(docs, schema), size), schema)


# --- words -----------------------------------------------------------------


def numbered(words: DataFrame) -> DataFrame:
    """Add id (from 1, by falling frequency) and before (occurrences of all words with a smaller id)."""
    order = [F.desc("f"), F.col("lang"), F.col("word")]
    placed = cut(
        words.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = placed.groupBy("part").agg(F.count("*").alias("rows"), F.sum("f").alias("sum")).select(
        "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum")
    )
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("rows") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    before = F.col("sum") + F.coalesce(F.sum("f").over(within), F.lit(0))
    known = cut(placed.join(F.broadcast(offsets), "part").select("lang", "word", "f", place.alias("id"), before.alias("before")))
    discard(placed)
    return known


# --- suffixes --------------------------------------------------------------


class Renumber:
    """A slice in the numbers of the corpus: 0 for a rare word and the end of a piece, else its id."""

    def __call__(self, left: pa.Table, right: pa.Table) -> pa.Table:
        texts, words = [], []
        if left.num_rows and right.num_rows:
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(left.column("tokens")[0].as_py()), np.uint8).reshape(4, -1)
            tokens = np.ascontiguousarray(planes.T).view("<u4").ravel()
            place, ids, before = (right.column(c).to_numpy().astype(np.int64) for c in ("place", "id", "before"))
            known = np.zeros(left.column("n_words")[0].as_py() + 1, np.uint32)
            known[place + 1] = ids
            order = np.argsort(ids)
            planes = np.ascontiguousarray(known[tokens].view(np.uint8).reshape(-1, 4).T)
            texts.append(zstandard.ZstdCompressor(level=1).compress(planes.tobytes()))
            words.append(squeeze(steps(ids[order].astype(np.uint64)), steps(before[order].astype(np.uint64))))
        return pa.table({"text": pa.array(texts, pa.binary()), "words": pa.array(words, pa.binary())})


class Suffixes:
    """Suffixes of a slice: up to four numbers of words, zeros behind the end; those of a single word are left out."""

    def __init__(self, text: bytes, words: bytes) -> None:
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8).reshape(4, -1)
        text = np.r_[np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64), np.zeros(DEPTH, np.int64)]
        ids, before = (np.cumsum(x).astype(np.int64) for x in unsqueeze(words))
        at = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
        self.columns = [text[at], text[at + 1]]
        for k in range(2, DEPTH):
            self.columns.append(np.where(self.columns[-1] > 0, text[at + k], 0))
        self.before = before[np.searchsorted(ids, self.columns[0])]


class Plan:
    """Prefixes that are extended: the group each starts at, and over how many its suffixes are dealt by the next word."""

    def __init__(self, levels: list[dict[tuple, tuple[int, int]]], groups: int, extended: int, budget: int) -> None:
        self.groups, self.extended, self.budget = groups, extended, budget
        self.levels, number = [], {(): 0}
        for level in levels:
            keys = {(number[p[:-1]] << 32) | p[-1]: p for p in level}
            order = sorted(keys)
            number = {keys[k]: i for i, k in enumerate(order)}
            first, parts = ([level[keys[k]][j] for k in order] for j in (0, 1))
            self.levels.append((np.array(order, np.int64), np.array(first, np.int64), np.array(parts, np.int64)))

    def find(self, columns: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows whose first `depth` words are an extended prefix, number of the prefix at that depth)."""
        rows, number = np.arange(len(columns[0])), np.zeros(len(columns[0]), np.int64)
        for k in range(depth):
            order = self.levels[k][0]
            key = (number << 32) | columns[k][rows]
            place = np.minimum(np.searchsorted(order, key), max(len(order) - 1, 0))
            same = order[place] == key if len(order) else np.zeros(len(key), bool)
            rows, number = rows[same], place[same]
        return rows, number

    def deal(self, columns: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        """Groups of suffixes: of the longest extended prefix, else by the running total before the first word."""
        group = self.groups + (before - self.extended) // self.budget
        for depth in range(1, len(self.levels) + 1):
            rows, number = self.find(columns, depth)
            _, first, parts = self.levels[depth - 1]
            after = columns[depth][rows] if depth < DEPTH else np.zeros(len(rows), np.int64)
            group[rows] = first[number] + (after * 0x9E3779B1 >> 7) % parts[number]
        return group

    def split(self, columns: list[np.ndarray], depth: int) -> np.ndarray:
        """Which nodes of this depth are extended prefixes, so that several groups may hold a part of them."""
        out = np.zeros(len(columns[0]), bool)
        if depth <= len(self.levels):
            out[self.find(columns, depth)[0]] = True
        return out


def summed(columns: list[np.ndarray], count: np.ndarray, group: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray | None]:
    """Equal suffixes (of a group) added up, in order."""
    pairs = [(columns[0] << 32) | columns[1], (columns[2] << 32) | columns[3]]
    keys = pairs if group is None else [group, *pairs]
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    total = np.add.reduceat(count[order], first) if len(first) else count
    low = (1 << 32) - 1
    columns = [x for k in keys[-2:] for x in (k[first] >> 32, k[first] & low)]
    return columns, total, None if group is None else keys[0][first]


def blob(columns: list[np.ndarray], count: np.ndarray) -> bytes:
    """Sorted suffixes as byte planes; the first word as differences."""
    arrays = [np.diff(columns[0], prepend=0), *columns[1:], count]
    planes = [np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T) for x in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.stack(planes).tobytes())


def unfold(data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(DEPTH + 1, 4, -1)
    arrays = [np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes]
    return [np.cumsum(arrays[0]), *arrays[1:DEPTH]], arrays[DEPTH]


class Looked:
    """Every STRIDE-th suffix of the hot words of a slice."""

    def __init__(self, hot: int) -> None:
        self.hot = hot

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        for text, words in zip(batch.column(0), batch.column(1)):
            columns = [c[::STRIDE] for c in Suffixes(text.as_py(), words.as_py()).columns]
            at = columns[0] <= self.hot
            yield {k: c[at] for k, c in zip(KEYS, columns)}


class Send:
    """The suffixes of a slice, added up, one blob for each group that has any."""

    def __init__(self, plan) -> None:
        self.plan = plan

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        for text, words in zip(batch.column(0), batch.column(1)):
            it = Suffixes(text.as_py(), words.as_py())
            group = self.plan.value.deal(it.columns, it.before)
            columns, count, group = summed(it.columns, np.ones(len(group), np.int64), group)
            starts, sizes = runs(group)
            blobs = [blob([c[a : a + n] for c in columns], count[a : a + n]) for a, n in zip(starts, sizes)]
            yield {"group": group[starts], "suffixes": pa.array(blobs, pa.binary())}
            del it, columns, count, group
            pa.default_memory_pool().release_unused()


class Grow:
    """The subtrees of a group: all nodes of two words and more that are frequent, or that other groups may hold a part of."""

    def __init__(self, plan, least: int) -> None:
        self.plan, self.least = plan, least

    def __call__(self, table: pa.Table) -> pa.Table:
        parts = [unfold(x.as_py()) for x in table.column("suffixes")]
        columns = [np.concatenate([p[0][k] for p in parts]) for k in range(DEPTH)]
        columns, leaves, _ = summed(columns, np.concatenate([p[1] for p in parts]))
        found = []
        for depth in range(2, DEPTH + 1):
            deep = np.flatnonzero(columns[depth - 1] > 0)
            if not len(deep):
                break
            words = [c[deep] for c in columns[:depth]]
            new = np.r_[True, np.logical_or.reduce([w[1:] != w[:-1] for w in words])]
            first = np.flatnonzero(new)
            total = np.add.reduceat(leaves[deep], first)
            words = [w[first] for w in words] + [np.zeros(len(first), np.int64)] * (DEPTH - depth)
            keep = (total >= self.least) | self.plan.value.split(words, depth)
            found.append([*(w[keep] for w in words), total[keep]])
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * (DEPTH + 1)
        return pa.table(dict(zip([*KEYS, "f"], columns)))


# --- the plan --------------------------------------------------------------


def plan_of(words: DataFrame, looked, budget: int) -> Plan:
    """The extended prefixes and the groups that they and all other words get. `looked` gives suffixes of the hot words."""
    limit = budget // 2
    hot = {(r["id"],): r["f"] for r in words.where(F.col("f") > limit).select("id", "f").collect()}
    weights = [hot]
    if hot:
        seen = cut(looked(len(hot)).groupBy(*KEYS).agg(F.count("*").alias("n")))
        for depth in range(2, DEPTH + 1):
            heavy = (
                seen.where(F.col(KEYS[depth - 1]) > 0).groupBy(*KEYS[:depth]).agg((F.sum("n") * STRIDE).alias("n")).where(F.col("n") > limit)
            )
            above = weights[-1]
            weights.append({p: r["n"] for r in heavy.collect() if (p := tuple(r[:depth]))[:-1] in above})
        discard(seen)
    levels, group = [], 0
    for depth, level in enumerate(weights):
        below = defaultdict(int)
        for p, n in weights[depth + 1].items() if depth + 1 < len(weights) else ():
            below[p[:-1]] += n
        levels.append({})
        for p, n in sorted(level.items()):
            parts = 1 if depth + 1 == DEPTH else max(1, math.ceil((n - below[p]) / budget))
            levels[-1][p] = (group, parts)
            group += parts
    return Plan(levels, group, sum(hot.values()), budget)


def counts(
    docs: DataFrame, text_col: str, lang_col: str, least: int, slice_words: int, budget: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(languages with n; words with lang, word, f, id; nodes with a, b, c, d and f), all of frequency `least` or more."""
    parts = cut(slices_of(docs, text_col, lang_col, slice_words))
    languages = cut(parts.groupBy("lang").agg(F.sum("n").alias("n")))
    each = parts.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select(
        F.col("slice").alias("owner"), "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("f")
    )
    words = numbered(each.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= least))
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    if total["rows"] >= 1 << 31:
        raise ValueError("more than 2^31 words are frequent: raise `least`")
    budget = max(2, budget, math.ceil(2 * total["n"] / PLAN))

    answers = each.drop("f").join(words.select("lang", "word", "id", "before"), ["lang", "word"]).select("owner", "place", "id", "before")
    renumber = Renumber()

    def in_numbers(left: pa.Table, right: pa.Table) -> pa.Table:
        return renumber(left, right)

    tokens = parts.select("slice", F.size("words").alias("n_words"), "tokens").groupBy("slice")
    texts = cut(tokens.cogroup(answers.groupBy("owner")).applyInArrow(in_numbers, "text binary, words binary"))
    discard(parts)

    numbers = ", ".join(f"{k} long" for k in KEYS)
    plan = docs.sparkSession.sparkContext.broadcast(plan_of(words, lambda hot: over_batches(texts, Looked(hot), numbers), budget))
    grow = Grow(plan, least)

    def subtrees(table: pa.Table) -> pa.Table:
        return grow(table)

    sent = over_batches(texts, Send(plan), "group long, suffixes binary")
    nodes = sent.groupBy("group").applyInArrow(subtrees, f"{numbers}, f long")
    nodes = cut(nodes.groupBy(*KEYS).agg(F.sum("f").alias("f")).where(F.col("f") >= least))
    discard(texts)
    return languages, words, nodes


# --- scores ----------------------------------------------------------------


def key_of(*names: str | None):
    return [F.col(n) if n else F.lit(0).cast("long") for n in [*names, *[None] * (DEPTH - len(names))]]


def shifted(rows: DataFrame, first: int, last: int, prefix: str) -> list:
    """The words first..last - 1 of a phrase as a key of their own."""
    return [c.alias(prefix + k) for c, k in zip(key_of(*KEYS[first:last]), KEYS)]


def length():
    return F.when(F.col("d") > 0, 4).when(F.col("c") > 0, 3).otherwise(2)


def looked_up(rows: DataFrame, known: DataFrame, prefix: str, name: str) -> DataFrame:
    keys = [prefix + k for k in KEYS]
    return spread_join(rows, known.select(*[F.col(k).alias(p) for k, p in zip(KEYS, keys)], F.col("f").alias(name)), keys).drop(*keys)


def scored(words: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates with the frequencies of their lowest cut: a..d, f, score, l, r."""
    known = words.select(*[c.alias(k) for c, k in zip(key_of("id"), KEYS)], "f").unionByName(nodes)
    cuts = []
    for size in range(2, DEPTH + 1):
        some = nodes.where(length() == size)
        for k in range(1, size):
            cuts.append(some.select(*KEYS, "f", F.lit(k).alias("k"), *shifted(some, 0, k, "l"), *shifted(some, k, size, "r")))
    every = cuts[0]
    for more in cuts[1:]:
        every = every.unionByName(more)
    every = looked_up(looked_up(every, known, "l", "l"), known, "r", "r")
    # decimals: twice a million times a count may pass 64 bits
    score = F.expr(f"cast(f as decimal(25,0)) * {SCALE} div cast(l + r as decimal(25,0))").cast("long")
    lowest = every.groupBy(*KEYS, "f").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    return lowest.select(*KEYS, "f", "x.score", "x.l", "x.r")


def standing(nodes: DataFrame) -> DataFrame:
    """Candidates that lie in no longer one with nearly all of their occurrences."""
    inner = []
    for size in range(3, DEPTH + 1):
        some = nodes.where(length() == size)
        for width in range(2, size):
            for first in range(size - width + 1):
                inner.append(some.select(*shifted(some, first, first + width, ""), F.col("f").alias("longer")))
    every = inner[0]
    for more in inner[1:]:
        every = every.unionByName(more)
    most = every.groupBy(*KEYS).agg(F.max("longer").alias("longer"))
    wide = "decimal(25,0)"
    stays = F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("f").cast(wide) * INSIDE)
    return nodes.join(most, KEYS, "left").where(stays).select(*KEYS)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = 2000,
    slice_words: int = SLICE, budget: int = BUDGET,
) -> DataFrame:
    """The best phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score."""
    languages, words, nodes = counts(docs, text_col, lang_col, least, slice_words, budget)
    ranked = scored(words, nodes).join(standing(nodes), KEYS)
    named = ranked.join(words.select(F.col("id").alias("a"), "lang"), "a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"))
    # all that can be among the first, ties included; only these need their words
    first = cut(named.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place"))
    spelled = (
        first.select(*KEYS, F.posexplode(F.array(*KEYS)).alias("at", "id")).where("id > 0").join(words.select("id", "word"), "id")
        .groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select(*KEYS, F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    return (
        first.join(spelled, KEYS).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        .join(languages, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
    )
