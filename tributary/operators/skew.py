"""Joins and orderings that hold when a few keys own most of the rows.

Aggregations need no help: Spark combines on the map side, so one hot group
arrives as one row per task. Joins, windows over a key and global orderings do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.session import block_rows, cut

# The frequent-items sketch tracks at most this many keys, 16 for each that can be hot.
TRACKED = 1_000_000
# The sketch reports at most this many keys.
REPORTED = 100_000
# It reports at least so many, which costs nothing, so that a table of more rows than guessed seldom is read again.
LEAST_REPORTED = 64
# Sketches of more tracked keys are not taken: one task merges those of all tasks. The keys are counted then.
SKETCHED = 100_000


def fits_broadcast(df: DataFrame) -> bool:
    """Does Catalyst's size estimate put `df` below the broadcast threshold?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= limit


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def has_no_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def block_size(spark: SparkSession, total: int, block: int | None = None) -> int:
    """Rows of a block: what one partition should hold, and more only where `total` would make
    the hot list longer than the sketch can tell apart. At most TRACKED / 16 keys are hot."""
    return max(block or block_rows(spark), math.ceil(16 * total / TRACKED))


Hot = list[tuple[int, int]]


def rows_guessed(df: DataFrame) -> int:
    """Rows by Catalyst's statistics, rather too many: from the size where no count is known."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    if stats.rowCount().isDefined():
        return int(str(stats.rowCount().get()))
    return int(str(stats.sizeInBytes())) // 4 + 1


def sketch(df: DataFrame, key_sets: Sequence[Sequence[str]], block: int | None = None) -> list[tuple[int, Hot]]:
    """For each set of keys: (rows without the key, hot list), all from one aggregate over `df`.

    A hot list holds (key hash, number of blocks) of the keys that own more rows than one block should hold, by a
    frequent-items sketch: no shuffle of keys, and one bounded row to the driver. A wrong estimate costs
    balance, never rows, because the list is fixed before either side is salted. The sketch is sized by Catalyst's
    row estimate; only if there are more rows than it can tell apart, it is taken again in the right size. Blocks so small that
    a sketch would have to be large are found by counting all keys, each in the task it falls to.
    """
    spark, guess = df.sparkSession, rows_guessed(df)
    reports = lambda rows: math.ceil(2 * rows / block_size(spark, rows, block)) + 1
    while True:
        kept = min(REPORTED, max(LEAST_REPORTED, reports(guess)))
        tracked = min(TRACKED, 8 * kept)
        hashes = df.select(*[F.when(~has_no_key(keys), key_hash(keys)).alias(f"h{i}") for i, keys in enumerate(key_sets)])
        if tracked > SKETCHED:
            return counted(hashes, block)
        facts = [F.count("*").alias("rows")]
        for i in range(len(key_sets)):
            top = f"approx_top_k(h{i}, {kept}, {tracked}) filter (where h{i} is not null)"
            facts += [F.count(f"h{i}").alias(f"n{i}"), F.expr(top).alias(f"top{i}")]
        seen = hashes.agg(*facts).first()
        if reports(seen["rows"]) <= kept or tracked == TRACKED:
            break
        guess = seen["rows"]
    found = []
    for i in range(len(key_sets)):
        size = block_size(spark, seen[f"n{i}"], block)
        top = seen[f"top{i}"] or []
        found.append((seen["rows"] - seen[f"n{i}"], [(t["item"], math.ceil(t["count"] / size)) for t in top if t["count"] > size]))
    return found


def counted(hashes: DataFrame, block: int | None) -> list[tuple[int, Hot]]:
    """What `sketch` finds for each column of key hashes, exactly; fewer than rows / block keys reach the driver."""
    columns = hashes.columns
    seen = hashes.agg(F.count("*").alias("rows"), *[F.count(h).alias(h) for h in columns]).first()
    sizes = [block_size(hashes.sparkSession, seen[h], block) for h in columns]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(h).alias("h")) for i, h in enumerate(columns)])).alias("e")
    counts = hashes.select(each).where("e.h is not null").groupBy("e.i", "e.h").agg(F.count("*").alias("n"))
    size = F.array(*[F.lit(s) for s in sizes])[F.col("i")]
    found: list[Hot] = [[] for _ in columns]
    for row in counts.where(F.col("n") > size).sort(F.desc("n"), "h").collect():
        found[row["i"]].append((row["h"], math.ceil(row["n"] / sizes[row["i"]])))
    return [(seen["rows"] - seen[h], hot) for h, hot in zip(columns, found)]


def find_hot(df: DataFrame, keys: Sequence[str], block: int | None = None) -> Hot:
    """The hot list of one set of keys."""
    return sketch(df, [keys], block)[0][1]


def hot_table(spark: SparkSession, hot: Hot) -> DataFrame:
    return F.broadcast(spark.createDataFrame(hot, "_h long, _blocks int"))


def salt_rows(df: DataFrame, keys: Sequence[str], hot: Hot) -> DataFrame:
    """Add `_salt`: which block of its key each row belongs to.

    The salt depends on the map task and on the other columns, so exact copies
    of a row spread too, and a task that runs again repeats its choice.
    """
    rest = [F.col(c) for c in df.columns if c not in keys]
    marked = df.withColumn("_h", key_hash(keys)).join(hot_table(df.sparkSession, hot), "_h", "left")
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *rest), F.coalesce("_blocks", F.lit(1))).cast("int")
    return marked.withColumn("_salt", spread).drop("_h", "_blocks")


def copy_to_blocks(df: DataFrame, keys: Sequence[str], hot: Hot) -> DataFrame:
    """One copy of every row per block of its key; all hot keys together have as many blocks as there are full ones, and one each."""
    marked = df.withColumn("_h", key_hash(keys)).join(hot_table(df.sparkSession, hot), "_h", "left")
    blocks = F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)
    return marked.withColumn("_salt", F.explode(blocks)).drop("_h", "_blocks")


def shuffles(df: DataFrame) -> bool:
    """Would reading `df` twice shuffle twice?"""
    return re.search(r"(?<!Broadcast)Exchange", df._jdf.queryExecution().executedPlan().toString()) is not None


class Chain:
    """A big table joined, key after key, to tables that are unique on their key (inner or left).

    Such joins never multiply rows, so what one sketch finds about all keys of the base table holds for every join
    that follows: no join's output is scanned for its hot keys. The sketch is taken when the first small side
    does not fit a broadcast; a base that shuffles is written before that, so its work is done once.

    Hot keys are cut into blocks and the one matching row is copied to each block. Rows without a key match nothing: an inner
    join drops them before anything moves, a left join sets them apart, so they pass by the shuffle.
    """

    def __init__(self, base: DataFrame, *keys: str | Sequence[str], block: int | None = None) -> None:
        self.base, self.parts, self.block = base, [base], block
        self.keys = [[k] if isinstance(k, str) else list(k) for k in keys]
        self.known: dict[tuple[str, ...], tuple[int, Hot]] = {}
        self.salts = False  # although a side would fit a broadcast

    @property
    def df(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)

    def hot(self, keys: list[str]) -> tuple[int, Hot]:
        """(rows without the key, hot list) of the base table."""
        if tuple(keys) not in self.known:
            if shuffles(self.base):
                self.base = cut(self.df)
                self.parts = [self.base]
            sets = self.keys if keys in self.keys else [*self.keys, keys]
            self.known |= zip(map(tuple, sets), sketch(self.base, sets, self.block))
        return self.known[tuple(keys)]

    def join(self, small: DataFrame, on: str | Sequence[str], how: str = "inner") -> Chain:
        keys = [on] if isinstance(on, str) else list(on)
        if how not in ("inner", "left"):
            raise ValueError(f"a chain cannot do a {how} join")
        for k in keys:
            small = small.withColumn(k, F.col(k).cast(self.base.schema[k].dataType))
        if not self.salts and fits_broadcast(small):
            self.parts = [p.join(small, keys, how) for p in self.parts]
            return self
        missing, hot = self.hot(keys)
        no_key, parts = has_no_key(keys), []
        gained = [f for f in small.schema if f.name not in keys]
        for part in self.parts:
            parts.append(salted_join(part.where(~no_key) if missing else part, small, keys, how, hot))
            if missing and how == "left":
                parts.append(part.where(no_key).withColumns({f.name: F.lit(None).cast(f.dataType) for f in gained}))
        self.parts = parts
        return self


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str, hot: Hot) -> DataFrame:
    if not hot:
        return big.join(small, keys, how)
    return salt_rows(big, keys, hot).join(copy_to_blocks(small, keys, hot), [*keys, "_salt"], how).drop("_salt")


def spread_join(
    big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner", hot: Hot | None = None, block: int | None = None
) -> DataFrame:
    """One such join. Small sides by Catalyst's estimate are left to its broadcast join. Pass `hot` when the key counts are
    already known; rows without a key are then set apart wherever the key may be null. Several joins of one table: see Chain."""
    chain = Chain(big, on, block=block)
    if hot is not None:
        keys, chain.salts = chain.keys[0], True
        chain.known[tuple(keys)] = int(any(big.schema[k].nullable for k in keys)), hot
    return chain.join(small, on, how).df


def positions(df: DataFrame, order: Sequence[Column], column: str = "position") -> DataFrame:
    """Number all rows 1..N in a total order without gathering them in one task.

    Range-partitioned sort; the place within a partition comes from the row id,
    and the rows before each partition from one count per partition. The sorted
    table is cut first, so both readings see the same partitions.
    """
    low = (1 << 33) - 1
    placed = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )  # one row per partition
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit(low)) + 1
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(column, place)
        .drop("_part", "_at", "_before")
    )
