"""Find spellings that mean the same artist and map them to one name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators.links import known_names
from tributary.operators.skew import spread_join
from tributary.session import cut


def name_list(df: DataFrame, *columns: str) -> DataFrame:
    """All real names of the given columns once: names(name)."""
    names = df.select(F.explode(F.array(*columns)).alias("name"))
    return known_names(names, "name").distinct()


def prefix_aliases(names: DataFrame) -> DataFrame:
    """(variant, canonical) where a name is another name plus a guest or backing group.

    Only prefixes of two or more words whose rest qualifies leave the first
    projection, so a name usually yields no row at all; the rest is an equi-join
    on the prefix.
    """
    keyed = names.select("name", text.match_key(F.col("name")).alias("key"))
    known = keyed.groupBy(F.col("key").alias("prefix")).agg(F.max("name").alias("canonical"))
    words = F.split("key", " ")

    def at(n):
        rest = F.slice("words", n + 1, F.size("words") - n)
        return F.struct(
            n.alias("n"),
            F.array_join(F.slice("words", 1, n), " ").alias("prefix"),
            text.is_qualifier(rest).alias("qualifies"),
        )

    cuts = F.transform(F.sequence(F.lit(2), F.size("words") - 1), at)
    candidates = (
        keyed.withColumn("words", words)
        .where(F.size("words") >= 3)
        .select("name", F.explode(F.filter(cuts, lambda c: c["qualifies"])).alias("c"))
        .select("name", "c.n", "c.prefix")
    )
    return (
        spread_join(candidates, known, "prefix")
        .where(F.lower("canonical") != F.lower("name"))
        .groupBy(F.col("name").alias("variant"))
        .agg(F.max_by("canonical", "n").alias("canonical"))
    )


def case_aliases(names: DataFrame) -> DataFrame:
    """(variant, canonical) for names that differ only in case and outer space."""
    keyed = names.select("name", text.case_key(F.col("name")).alias("key"))
    best = (
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(text.case_rank(F.col("name"))).alias("best"))
        .where(F.col("n") > 1)
        .select("key", F.col("best.name").alias("canonical"))
    )
    return (
        spread_join(keyed, best, "key")
        .where(F.col("name") != F.col("canonical"))
        .select(F.col("name").alias("variant"), "canonical")
    )


def merge_aliases(general: DataFrame, special: DataFrame) -> DataFrame:
    """Union of two maps; `special` wins where both know a variant."""
    ranked = general.withColumn("rank", F.lit(0)).unionByName(special.withColumn("rank", F.lit(1)))
    return ranked.groupBy("variant").agg(F.max_by("canonical", "rank").alias("canonical"))


def build_alias_map(names: DataFrame) -> DataFrame:
    """Both kinds of aliases of names(name); the list is read four times, so it is written once."""
    names = cut(names)
    return merge_aliases(case_aliases(names), prefix_aliases(names))


def apply_aliases(df: DataFrame, aliases: DataFrame, column: str = "name") -> DataFrame:
    """Replace mapped names, then clean all of them up."""
    mapped = spread_join(df, aliases.withColumnRenamed("variant", column), column, how="left")
    resolved = F.coalesce("canonical", column)
    return mapped.withColumn(column, text.clean_name(resolved)).drop("canonical")
