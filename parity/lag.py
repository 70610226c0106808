"""The row before within a group, for deriving the stand-in tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.skew import find_hot, has_no_key, hot_table, key_hash

# Rows without a key are spread over so many window partitions.
NULL_BLOCKS = 1024


def previous_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    column: str,
    hot: list[tuple[int, int]] | None = None,
    blocks: int = 256,
) -> DataFrame:
    """The preceding `order` value of the same key, one output row per input row.

    Returns keys, order and `column`. Keys that are not hot use a plain window.
    Hot keys are cut into ranges of `order`; the last value of each range is
    carried over, so no task sees a whole hot key. Copies are counted per map
    task and unrolled again after the window. Rows without a key have no
    predecessor and are spread over the tasks.
    """
    base = df.select(*keys, order)
    if hot is None:
        hot = find_hot(base, keys)
    no_key = has_no_key(keys)
    spread = F.when(no_key, F.pmod(F.xxhash64(order), F.lit(NULL_BLOCKS)))
    plain = Window.partitionBy(*keys, spread).orderBy(order)
    before = F.when(~no_key, F.lag(order).over(plain))
    if not hot:
        return base.withColumn(column, before)

    marked = base.withColumn("_h", key_hash(keys)).join(
        hot_table(df.sparkSession, hot), "_h", "left"
    )
    usual = marked.where(F.col("_blocks").isNull()).select(*keys, order)
    usual = usual.withColumn(column, before)

    heavy = marked.where(F.col("_blocks").isNotNull()).select(*keys, order)
    steps = [i / blocks for i in range(1, blocks)]
    bounds = heavy.agg(F.percentile_approx(order, steps).alias("b")).first()["b"] or []
    ranges = F.array(*[F.lit(b) for b in sorted(set(bounds))]) if bounds else F.array()
    counted = (
        heavy.groupBy(*keys, order, F.spark_partition_id().alias("_task"))
        .agg(F.count("*").alias("_copies"))
        .withColumn("_range", F.size(F.filter(ranges, lambda b: b < F.col(order))))
    )
    within = Window.partitionBy(*keys, "_range").orderBy(order, "_task")
    ahead = Window.partitionBy(*keys).orderBy("_range")
    carried = (
        counted.groupBy(*keys, "_range")
        .agg(F.max(order).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(ahead))  # at most `blocks` rows per key
        .drop("_last")
    )
    linked = (
        counted.withColumn("_prev", F.lag(order).over(within))
        .join(carried, [*keys, "_range"])
        .withColumn("_first", F.coalesce("_prev", "_carry"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn(column, F.when(F.col("_copy") == 1, F.col("_first")).otherwise(F.col(order)))
    )
    return usual.unionByName(linked.select(*keys, order, column))
