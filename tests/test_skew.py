import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parity.lag import previous_in_group
from tributary.operators import skew
from tributary.session import cut

FORCED = {"block": 150}


def skewed(spark, n=3000):
    """A third of the rows on key 7, some keys missing, many exact copies."""
    data = [(None if i % 17 == 0 else 7 if i % 3 == 0 else i % 90, i % 5) for i in range(n)]
    return spark.createDataFrame(data, "k long, v int").repartition(6)


def no_broadcast(monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, monkeypatch, how):
    no_broadcast(monkeypatch)
    big = skewed(spark)
    small = spark.createDataFrame([(k, f"name {k}") for k in range(60)], "k int, name string")
    assert skew.find_hot(big, ["k"], **FORCED)
    ours = skew.spread_join(big, small, "k", how, **FORCED)
    assert Counter(rows(ours, "k", "v", "name")) == Counter(rows(big.join(small, "k", how), "k", "v", "name"))


def test_spread_join_on_two_keys(spark, monkeypatch):
    no_broadcast(monkeypatch)
    big = skewed(spark).withColumn("x", F.lit(1))
    small = big.select("k", "v").distinct().withColumn("s", F.col("k") + F.col("v"))
    ours = skew.spread_join(big, small, ["k", "v"], block=60)
    assert Counter(rows(ours, "k", "v", "s")) == Counter(rows(big.join(small, ["k", "v"]), "k", "v", "s"))


def test_hot_key_lands_in_many_partitions(spark):
    big = spark.range(4000).select((F.col("id") * 0 + 1).alias("k"), F.col("id").alias("v")).repartition(4)
    hot = skew.find_hot(big, ["k"], block=200)
    assert len(hot) == 1 and hot[0][1] == 20
    sizes = [r["count"] for r in skew.salt_rows(big, ["k"], hot).groupBy("_salt").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 400


def test_copies_of_one_row_spread(spark):
    big = spark.range(4000).select(F.lit(1).alias("k"), F.lit(2).alias("v")).repartition(16)
    salted = skew.salt_rows(big, ["k"], skew.find_hot(big, ["k"], **FORCED))
    assert salted.select("_salt").distinct().count() > 4


def test_few_rows_have_no_hot_keys(spark):
    assert skew.find_hot(skewed(spark), ["k"]) == []


def test_positions_number_all_rows_in_order(spark):
    random.seed(1)
    data = [(random.choice([1.0, 1.0, 1.0, 2.0, 5.0]), f"n{i:04d}") for i in range(1000)]
    placed = skew.positions(spark.createDataFrame(data, "s double, n string"), [F.desc("s"), F.asc("n")])
    got = [(r["s"], r["n"]) for r in sorted(placed.collect(), key=lambda r: r["position"])]
    assert got == sorted(data, key=lambda t: (-t[0], t[1]))
    assert [r["position"] for r in placed.orderBy("position").collect()] == list(range(1, 1001))


def test_positions_of_nothing(spark):
    assert skew.positions(spark.createDataFrame([], "s int"), [F.asc("s")]).count() == 0


def test_previous_in_group_of_a_hot_key(spark):
    random.seed(2)
    data = [(1 if i % 3 else i % 40, random.randrange(500)) for i in range(2000)]
    data += [(1, 77)] * 700 + [(None, i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, o int").repartition(5)
    plain = previous_in_group(df, ["k"], "o", "before", hot=[])
    hot = skew.find_hot(df, ["k"], **FORCED)
    assert hot
    split = previous_in_group(df, ["k"], "o", "before", hot=hot, blocks=16)
    assert Counter(rows(split)) == Counter(rows(plain))
    assert split.count() == len(data)
    assert split.where("k is null and before is not null").count() == 0


def test_the_hot_list_stays_within_what_the_sketch_tells_apart(spark):
    assert skew.block_size(spark, 1_000) == 500_000
    total = 10**13
    assert total / skew.block_size(spark, total) <= skew.TRACKED / 16


def test_no_partition_of_a_layout_holds_more_than_twice_the_plan(spark):
    """A source of 40 % of the arcs, laid out as the loops do."""
    from tributary.operators.pagerank import hot_sources
    from tributary.session import layout_width

    arcs = spark.range(40_000).select(F.when(F.col("id") % 5 < 2, -1).otherwise(F.col("id")).alias("src"), "id")
    spark.conf.set("spark.tributary.blockRows", "1000")
    try:
        counts = arcs.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("links"))
        hot = hot_sources(counts, 40_000)
        laid = skew.salt_rows(arcs, ["src"], hot).repartition(layout_width(spark, 40_000), "src", "_salt")
        sizes = laid.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.tributary.blockRows")
    assert hot == [(hot[0][0], 16)]
    assert max(r["count"] for r in sizes) <= 3000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, key, column):
    return spark.createDataFrame([(k, f"{column} {k}") for k in range(60)], f"{key} long, {column} string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_chain_equals_plain_joins(spark, monkeypatch, how):
    no_broadcast(monkeypatch)
    data = [(None if i % 17 == 0 else 7 if i % 3 == 0 else i % 90, None if i % 5 == 0 else i % 70, i % 4) for i in range(3000)]
    big = cut(spark.createDataFrame(data, "a long, b long, v int").repartition(6))
    sides = facts(spark, "a", "x"), facts(spark, "b", "y")
    chain = skew.Chain(big, "a", "b", **FORCED).join(sides[0], "a", how).join(sides[1], "b", how)
    plain = big.join(sides[0], "a", how).join(sides[1], "b", how)
    columns = ["a", "b", "v", "x", "y"]
    assert Counter(rows(chain.df, *columns)) == Counter(rows(plain, *columns))
    assert chain.known[("a",)][0] == len([d for d in data if d[0] is None]) and chain.known[("a",)][1]


def test_rows_without_a_key_pass_by_the_shuffle(spark, monkeypatch):
    no_broadcast(monkeypatch)
    big = cut(skewed(spark))
    chain = skew.Chain(big, "k", **FORCED).join(facts(spark, "k", "x"), "k", "left")
    matched, passed = chain.parts
    assert "Exchange" not in plan(passed) and passed.count() == big.where("k is null").count()
    scanned = [x for x in plan(matched).splitlines() if "PushedFilters" in x and "IsNotNull(k)" in x]
    assert scanned and matched.where("k is null").count() == 0


def test_a_chain_scans_its_base_once_for_all_keys(spark, monkeypatch):
    no_broadcast(monkeypatch)
    seen, sketch = [], skew.sketch
    monkeypatch.setattr(skew, "sketch", lambda df, sets, block=None: seen.append((df, sets)) or sketch(df, sets, block))
    big = cut(spark.range(2000).selectExpr("id % 3 as a", "id % 50 as b", "id as v"))
    skew.Chain(big, "a", "b", **FORCED).join(facts(spark, "a", "x"), "a").join(facts(spark, "b", "y"), "b").df.count()
    assert [sets for _, sets in seen] == [[["a"], ["b"]]] and seen[0][0] is big


def test_no_sketch_reads_a_join(spark, monkeypatch):
    """Planning the whole graph build without broadcasts: hot keys are looked up in base and written tables alone."""
    from parity import catalogue
    from parity.queries import small_blocks
    from tributary.plans import build

    folder = "/root/testdata/sf0.001"
    tables = {name: cut(t) for name, t in catalogue.tables(spark, folder).items()}
    aliases = cut(catalogue.alias_table(spark, folder))
    seen, sketch = [], skew.sketch
    monkeypatch.setattr(skew, "sketch", lambda df, sets, block=None: seen.append(plan(df)) or sketch(df, sets, block))
    with small_blocks(spark, 20):
        build.build_graph(tables, aliases)
    assert len(seen) == 8 and not any("Join" in p or "Exchange" in p for p in seen)


def test_the_sketch_is_taken_again_if_there_are_more_rows_than_guessed(spark, monkeypatch):
    monkeypatch.setattr(skew, "rows_guessed", lambda df: 1)
    df = spark.range(5000).selectExpr("if(id % 2 = 0, 1, id) as k", "if(id % 10 = 0, null, 5) as j")
    (none, first), (missing, second) = skew.sketch(df, [["k"], ["j"]], block=1000)
    assert (none, missing) == (0, 500) and [b for _, b in first] == [3] and [b for _, b in second] == [5]


def test_large_sketches_give_way_to_counts(spark, monkeypatch):
    """No task merges sketches that grow with tables and small blocks; what is found is the same."""
    df = spark.range(5000).selectExpr("if(id % 2 = 0, 1, id) as k", "if(id % 10 = 0, null, id % 3) as j")
    by_sketch = skew.sketch(df, [["k"], ["j"], ["k", "j"]], block=400)
    monkeypatch.setattr(skew, "SKETCHED", 0)
    merged, counted = [], skew.counted
    monkeypatch.setattr(skew, "counted", lambda hashes, block: merged.append(hashes.columns) or counted(hashes, block))
    by_count = skew.sketch(df, [["k"], ["j"], ["k", "j"]], block=400)
    assert [(none, sorted(hot)) for none, hot in by_count] == [(none, sorted(hot)) for none, hot in by_sketch]
    assert merged == [["h0", "h1", "h2"]] and all(hot for _, hot in by_count)


def test_small_blocks_bring_no_task_for_each(spark):
    """A step of a loop has a bounded number of tasks a core until partitions are full."""
    from tributary.session import BLOCK_ROWS, WAVES, layout_width

    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.tributary.blockRows", "200")
    try:
        assert layout_width(spark, 3_000_000) == WAVES * cores
        assert layout_width(spark, 1000 * BLOCK_ROWS) == 1000
        assert layout_width(spark, 100) == cores
    finally:
        spark.conf.unset("spark.tributary.blockRows")


def test_some_more_rows_than_guessed_are_not_read_twice(spark, monkeypatch):
    df = spark.range(5000).selectExpr("if(id % 2 = 0, 1, id) as k")
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    seen = {}
    for guess, block in ((5000, 1000), (1250, 1000), (1, 10)):
        monkeypatch.setattr(skew, "rows_guessed", lambda df: guess)
        before = jobs()
        hot = skew.find_hot(df, ["k"], block=block)
        seen[guess] = jobs() - before, [b for _, b in hot]
    assert seen[1250] == seen[5000] and seen[5000][1] == [3]
    assert seen[1] == (2 * seen[5000][0], [251])  # more keys may be hot than so small a sketch tells apart
