"""Rankings, their comparison and Spearman correlation."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.skew import positions, spread_join
from tributary.session import share_code


def add_ranks(df: DataFrame, score: str, tie_break: str, prefix: str, descending: bool = True) -> DataFrame:
    """Add `<prefix>_position`, `<prefix>_rank` (lowest of a tie) and `<prefix>_avg_rank`.

    One distributed sort numbers the rows; a tie's ranks follow from its first
    and last position.
    """
    by = F.desc(score) if descending else F.asc(score)
    placed = positions(df, [by, F.asc(tie_break)], f"{prefix}_position")
    place = f"{prefix}_position"
    ties = placed.groupBy(score).agg(
        F.min(place).alias(f"{prefix}_rank"),
        ((F.min(place) + F.max(place)) / 2).alias(f"{prefix}_avg_rank"),
    )
    return spread_join(placed, ties, score)


def volume_and_authority(volume: DataFrame, scores: DataFrame) -> DataFrame:
    """(artist, times_sampled, authority_score) of the artists in both tables."""
    return volume.join(scores, "artist", "inner")


def compare_ranks(both: DataFrame) -> DataFrame:
    """Rank by volume, rank by authority and how far they lie apart."""
    ranked = add_ranks(both, "times_sampled", "artist", "vol")
    ranked = add_ranks(ranked, "authority_score", "artist", "auth")
    return ranked.select(
        "artist",
        "times_sampled",
        "authority_score",
        "vol_rank",
        "auth_rank",
        (F.col("vol_rank") - F.col("auth_rank")).alias("divergence"),
    )


def watch(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of the artists on a watch-list."""
    return df.join(names.select("artist"), "artist", "left_semi")


def in_key_order(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of keys(artist, place) in that order; keys without a row keep nulls."""
    return keys.join(df, "artist", "left").orderBy("place")


def two_sided_p(rho: Column, n: Column) -> Column:
    """Two-sided p of a rank correlation by Student's t with n-2 degrees of freedom."""

    @F.pandas_udf("double")
    def p_value(rhos: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([correlation_p(r, n) for r, n in zip(rhos, counts)], dtype="float64")

    return p_value(rho.cast("double"), n.cast("double"))


def correlation_p(r: float | None, n: float) -> float:
    """P(|T| > t): the regularized incomplete beta function at 1 - r^2 with (n-2)/2 and 1/2.

    By its continued fraction, from the side where that converges in a few steps
    whatever n is.
    """
    v = n - 2
    if r is None or r != r or v <= 0:
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    a, near = v / 2, r * r
    # x^a (1-x)^b / B(a, b) with x = 1 - r^2 and b = 1/2
    front = math.exp(a * math.log1p(-near) + 0.5 * math.log(near) - log_beta_half(a)) if near else 0.0
    if 1 - near < (a + 1) / (a + 2.5):
        return min(1.0, front * beta_fraction(a, 0.5, 1 - near) / a)
    return min(1.0, 1 - front * beta_fraction(0.5, a, near) / 0.5)


def log_beta_half(a: float) -> float:
    """log B(a, 1/2). For large a by series: the difference of two large log-gammas would lose its digits."""
    half = math.lgamma(0.5)
    if a < 1000:
        return math.lgamma(a) + half - math.lgamma(a + 0.5)
    return half - (0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3))


def beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, evaluated from its front."""
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    value, m = d, 0
    while True:
        m += 1
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / ((1 + term * d) or tiny)
            c = (1 + term / c) or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            return value


def spearman(df: DataFrame, left: str, right: str, tie_break: str, alpha: float = 0.05) -> DataFrame:
    """One row (rho, p_value, n, not_significant); rho and p are NaN for fewer than two rows."""
    share_code(df.sparkSession)
    ranked = add_ranks(df.select(*dict.fromkeys([tie_break, left, right])), left, tie_break, "l", descending=False)
    ranked = add_ranks(ranked, right, tie_break, "r", descending=False)
    nan = F.lit(float("nan"))
    measured = ranked.agg(
        F.corr("l_avg_rank", "r_avg_rank").alias("rho"), F.count("*").alias("n")
    ).withColumn("rho", F.when(F.col("n") > 1, F.coalesce("rho", nan)).otherwise(nan))
    p_value = F.coalesce(two_sided_p(F.col("rho"), F.col("n")), nan)
    tested = measured.withColumn("p_value", p_value)
    weak = (F.col("p_value") > alpha) & ~F.isnan("p_value")
    return tested.select("rho", "p_value", "n", weak.alias("not_significant"))
