"""Align a ranking with an outside list of names and report how well they agree."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.similarity import score_words
from tributary.operators.components import components
from tributary.operators.context import top_scored
from tributary.operators.name_index import Bounds, can_match, listed_keys, ranked_keys, signed
from tributary.operators.ranking import spearman
from tributary.operators.skew import positions, spread_join
from tributary.operators.statistics import long_report
from tributary.session import cut, discard, share_code

# The outside list, most reused artists first.
GROUND_TRUTH = [
    "James Brown", "Public Enemy", "Run-D.M.C.", "The Winstons", "Lyn Collins", "Kraftwerk",
    "Michael Jackson", "The Beatles", "The Notorious B.I.G.", "Madonna", "Queen", "David Bowie",
    "Led Zeppelin", "Prince", "The Bomb Squad", "Parliament", "Funkadelic", "Beastie Boys",
    "Kool & the Gang", "Sly & the Family Stone", "Marvin Gaye", "Stevie Wonder", "Isaac Hayes",
    "Curtis Mayfield", "The Isley Brothers", "The Temptations", "The Supremes", "Aretha Franklin",
    "Ray Charles", "Elvis Presley",
]


#: Pairs of one component of competing names that a single task may settle; larger components go in rounds.
SETTLED = 1_000_000


def candidates(scores: DataFrame, top: int | None = None) -> DataFrame:
    """(artist, authority_score, system_rank) of the artists that may be matched: all, or the `top` best."""
    order = [F.desc("authority_score"), F.asc("artist")]
    if top is None:
        return positions(scores, order, "system_rank").select("artist", "authority_score", "system_rank")
    best = top_scored(scores, top)
    return best.withColumn("system_rank", F.row_number().over(Window.orderBy(*order)).cast("long"))  # over `top` rows


def similar(truth: DataFrame, pool: DataFrame, threshold: int = 85) -> DataFrame:
    """All (ground_truth, artist) with a token-set score of at least `threshold` (50 to 100).

    Ranked and listed names meet in an index of words and letter counts; only pairs within the
    exact bounds of the threshold are compared letter by letter.
    """
    share_code(pool.sparkSession)
    bounds = Bounds(threshold)
    listed = truth.select("ground_truth", F.col("ground_truth_rank").cast("int").alias("ground_truth_rank"))
    facts = pool.select(F.col("artist").cast("string").alias("artist"), "system_rank", "authority_score")
    theirs = listed_keys(signed(listed, "ground_truth", bounds), bounds)
    # written, so that Catalyst sees the size of all keys and not that of the list
    theirs = cut(theirs.select(*listed.columns, "key", *[F.col(c).alias(f"{c}_") for c in SIGNS]))
    ours = ranked_keys(signed(facts, "artist", bounds), bounds).select(*facts.columns, *SIGNS, "key")
    met = ours.join(theirs, "key")
    fits = can_match({c: F.col(c) for c in SIGNS}, {c: F.col(f"{c}_") for c in SIGNS}, bounds)
    pairs = met.where(fits).select(*facts.columns, *listed.columns, "words", "words_").dropDuplicates([*facts.columns, *listed.columns])
    schema = "artist string, system_rank long, authority_score double, ground_truth string, ground_truth_rank int, match_score int"
    return pairs.mapInPandas(score_with(threshold), schema)


#: What two names are held against each other by, before their letters are compared in order.
SIGNS = ["words", "n", "letters"]


def score_with(threshold: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = [score_words(frozenset(b), frozenset(a), threshold) for a, b in zip(batch.pop("words"), batch.pop("words_"))]
            batch["match_score"] = points
            yield batch[batch["match_score"] >= threshold]

    return compare


def assign(pairs: DataFrame, settled: int = SETTLED) -> DataFrame:
    """Give each outside name its best free candidate; earlier names choose first.

    Names compete only if they share candidates, so each connected component of names and artists is settled on its own, in one
    task if it has at most `settled` pairs. All components of a table that small are settled together. Larger ones go in rounds: all names ask for their
    best candidate at once, a candidate keeps the earliest asker and turns the later ones away for good.
    """
    pairs = cut(pairs)
    columns = "ground_truth string, ground_truth_rank int, matched_artist string, system_rank long, authority_score double, match_score int"
    if pairs.count() <= settled:
        chosen = pairs.groupBy().applyInPandas(choose, columns)
        return chosen.orderBy("ground_truth_rank")
    names = pairs.select(F.xxhash64(F.lit("name"), "ground_truth_rank").alias("a"), F.xxhash64(F.lit("artist"), "artist").alias("b"))
    roots = cut(components(names).withColumnRenamed("node", "name"))
    placed = pairs.withColumn("name", F.xxhash64(F.lit("name"), "ground_truth_rank")).join(roots, "name").drop("name")
    sizes = cut(placed.groupBy("root").agg(F.count("*").alias("pairs")))
    placed = cut(placed.join(sizes, "root"))
    small = placed.where(F.col("pairs") <= settled).groupBy("root").applyInPandas(choose, columns)
    large = placed.where(F.col("pairs") > settled).select(pairs.columns)
    return small.unionByName(in_rounds(large)).orderBy("ground_truth_rank")


def choose(pairs: pd.DataFrame) -> pd.DataFrame:
    """One by one, in the order of the outside names."""
    ordered = pairs.sort_values(["ground_truth_rank", "match_score", "system_rank", "artist"], ascending=[True, False, True, True], kind="stable")
    taken, served, rows = set(), set(), []
    for at, name, artist in zip(ordered.index, ordered["ground_truth_rank"], ordered["artist"]):
        if name not in served and artist not in taken:
            served.add(name)
            taken.add(artist)
            rows.append(at)
    chosen = ordered.loc[rows].rename(columns={"artist": "matched_artist"})
    return chosen[["ground_truth", "ground_truth_rank", "matched_artist", "system_rank", "authority_score", "match_score"]]


def in_rounds(pairs: DataFrame) -> DataFrame:
    """The same choice with all names asking at once, usually after two or three rounds."""
    wish = F.struct((-F.col("match_score")).alias("falling"), F.col("system_rank"), F.col("artist"))
    open_pairs = cut(pairs)
    while True:
        wishes = open_pairs.groupBy("ground_truth_rank").agg(F.min(wish).alias("wish"))
        holders = wishes.groupBy(F.col("wish.artist").alias("artist")).agg(
            F.min("ground_truth_rank").alias("holder"), F.count("*").alias("askers")
        )
        judged = spread_join(open_pairs, holders, "artist", "left")
        if holders.where(F.col("askers") > 1).isEmpty():
            won = F.col("ground_truth_rank") == F.col("holder")
            chosen = judged.join(wishes, "ground_truth_rank").where(won & (F.col("wish.artist") == F.col("artist")))
            return chosen.select(
                "ground_truth",
                "ground_truth_rank",
                F.col("artist").alias("matched_artist"),
                "system_rank",
                "authority_score",
                "match_score",
            )
        stays = F.col("holder").isNull() | (F.col("ground_truth_rank") <= F.col("holder"))
        before = open_pairs
        open_pairs = cut(judged.where(stays).select(open_pairs.columns))
        discard(before)


def align(truth: DataFrame, scores: DataFrame, top: int | None = None, threshold: int = 85) -> DataFrame:
    """(ground_truth, ground_truth_rank, matched_artist, system_rank, authority_score, match_score)."""
    pool = cut(candidates(scores, top))
    return assign(similar(truth, pool, threshold))


def agreement(truth: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: Spearman's rho of both ranks over the matches, p, and both list sizes."""
    tested = spearman(matches, "ground_truth_rank", "system_rank", "ground_truth_rank")
    return tested.select(
        F.col("rho").alias("Spearman_Rank_Correlation"),
        F.col("p_value").alias("P_value"),
        truth.agg(F.count("*")).scalar().alias("Number_of_ground_truth_artists"),
        F.col("n").alias("Number_of_matched_artists"),
        "not_significant",
    )


def agreement_report(truth: DataFrame, matches: DataFrame) -> DataFrame:
    """The long (metric, value) form, rounded to 4 places."""
    return long_report(agreement(truth, matches).drop("not_significant")).select(
        "metric", F.round("value", 4).alias("value")
    )
