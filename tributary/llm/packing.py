"""Best-fit decreasing packing of token sequences.

A document is its token ids and one end id. Documents longer than a sequence are cut into pieces of full length, of which the first may
be shorter; others stay whole. Pieces are then placed from the longest to the shortest, each in the open sequence that
it fills best. A segment tree over remaining capacities names that sequence in logarithmic time.

Lengths are at most `size`, so the plan needs only how many pieces have each length: pieces of one length
are placed in one go, as often as the sequences of the chosen capacity hold them. That gives exactly the sequences of best-fit decreasing over all pieces,
while the driver sees `size` counts at most. The plan is a list of rules (length, first rank, count, first sequence, pieces in each,
place); its length depends on `size` alone. Spark numbers the pieces of a length (by task and place in the task, then a running sum over tasks)
and every piece finds its rule by rank.

Null text is empty: the end id alone. Ties are broken by task and row order. Repeated rows are packed as often as they occur; null ids are
kept. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import ROWS_OUT, arrow_schema, as_batch, over_batches
from tributary.llm.tokens import byte_level
from tributary.session import cut

SIZE = 2048
END = 0


# --- pieces ----------------------------------------------------------------


class Cut:
    def __init__(self, path: str, size: int, end: int, schema: pa.Schema) -> None:
        self.path, self.size, self.end, self.schema = path, size, np.array([end], "<u4").tobytes(), schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, size = byte_level(self.path).ids, self.size
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in ("row", "piece", "start", "length", "ids", "place")}
            held = 0
            for row, text in enumerate(batch.column(1)):
                ids = ids_of(text.as_py()) + self.end
                total = len(ids) // 4
                first = total % size or size
                for piece, start in enumerate([0, *range(first, total, size)]):
                    length = first if piece == 0 else size
                    rows["row"].append(row)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(length)
                    rows["ids"].append(ids[4 * start : 4 * (start + length)])
                    rows["place"].append(seen[length])
                    seen[length] += 1
                held += len(ids)
                if held > 1 << 22:
                    yield self.out(batch, rows, task)
                    held = 0
            if rows["row"]:
                yield self.out(batch, rows, task)
            del batch
            pa.default_memory_pool().release_unused()

    def out(self, batch: pa.RecordBatch, rows: dict, task: int) -> pa.RecordBatch:
        at = pa.array(rows["row"], pa.int64())
        made = {**rows, "id": batch.column(0).take(at), "task": [task] * len(at)}
        whole = as_batch(made, self.schema)
        for column in rows.values():
            column.clear()
        return whole


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END
) -> DataFrame:
    """id, piece, start, length, ids (little-endian unsigned 32-bit), and task and place, which `pack` numbers by."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids binary, task long, place long"
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return given.mapInArrow(Cut(tokenizer, size, end, arrow_schema(docs, schema)), schema)


# --- the plan --------------------------------------------------------------


class Capacities:
    """Segment tree over remaining capacities: which is the smallest one, of at least n, that an open sequence has."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, there: bool) -> None:
        at = self.leaves + capacity
        self.any[at] = there
        while at := at >> 1:
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def at_least(self, n: int) -> int | None:
        at = self.leaves + n
        if self.any[at]:
            return n
        while at > 1:  # up until a right neighbour has one, then down to its smallest
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing: (length, first rank, count, first sequence, pieces in each, place of the first)."""
    tree, open_, rules, made = Capacities(size), {}, [], 0

    def add(capacity: int, first: int, count: int) -> None:
        if count and capacity:
            open_.setdefault(capacity, []).append((first, count))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.at_least(length)
            if capacity is None:  # new sequences, each filled before the next is opened
                capacity, first, here = size, made, -(-left // (size // length))
                made += here
            else:
                first, here = open_[capacity].pop()
                if not open_[capacity]:
                    del open_[capacity]
                    tree.set(capacity, False)
            each = capacity // length
            take = min(left, here * each)
            rules.append((length, rank, take, first, each, size - capacity))
            full, rest = divmod(take, each)
            add(capacity - each * length, first, full)
            if rest:
                add(capacity - rest * length, first + full, 1)
            add(capacity, first + full + bool(rest), here - full - bool(rest))
            rank, left = rank + take, left - take
    return rules


class Place:
    """Unfolds (task, length, how many, first rank) into a row per piece with its sequence and offset."""

    def __init__(self, rules) -> None:
        self.rules = rules

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        rules = self.rules.value
        task, length, count, before = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
        starts = np.cumsum(count) - count
        for at in range(0, int(count.sum()), ROWS_OUT):
            n = np.arange(at, min(at + ROWS_OUT, int(count.sum())))
            group = np.searchsorted(starts, n, side="right") - 1
            place = n - starts[group]
            rank, size = before[group] + place, length[group]
            rule = np.zeros(len(n), np.int64)
            for k in np.unique(size):
                mine, (first, last) = size == k, np.searchsorted(rules[:, 0], [k, k + 1])
                rule[mine] = first + np.searchsorted(rules[first:last, 1], rank[mine], side="right") - 1
            i, each = rank - rules[rule, 1], rules[rule, 4]
            yield {
                "task": task[group], "length": size, "place": place,
                "sequence_id": rules[rule, 3] + i // each, "offset": rules[rule, 5] + i % each * size,
            }


def pack(cut_pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to a table of `pieces` (ids may have been dropped).

    The table is written first, so that task and place stay what they are when
    an executor is lost.
    """
    table = cut(cut_pieces)
    spark = table.sparkSession
    groups = table.groupBy("task", "length").agg(F.count("*").alias("count"))
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `size` rows at most
    rules = np.array(plan(counts, size), np.int64).reshape(-1, 6)
    rules = spark.sparkContext.broadcast(rules[np.lexsort((rules[:, 1], rules[:, 0]))])
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranked = groups.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    schema = "task long, length long, place long, sequence_id long, offset long"
    placed = over_batches(ranked, Place(rules), schema)
    return table.join(placed, ["task", "length", "place"]).drop("task", "place")
