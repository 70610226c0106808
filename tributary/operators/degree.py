"""Degree centrality, its distribution, and hub roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scales import at_least_one, percent
from tributary.functions.text import readable
from tributary.operators.links import UNKNOWN
from tributary.operators.skew import spread_join

# Lower bounds of the cumulative degree classes.
DEGREE_CLASSES = [1, 5, 10, 50, 100]


def known(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).cast("string") != UNKNOWN)


def in_degree(edges: DataFrame) -> DataFrame:
    """(artist, times_sampled): edges pointing at each known artist, unweighted."""
    counted = known(edges, "dst").groupBy(F.col("dst").alias("artist"))
    return counted.agg(F.count("*").alias("times_sampled"))


def out_degree(edges: DataFrame) -> DataFrame:
    """(artist, samples_used): edges leaving each known artist."""
    counted = known(edges, "src").groupBy(F.col("src").alias("artist"))
    return counted.agg(F.count("*").alias("samples_used"))


def top_songs(edges: DataFrame) -> DataFrame:
    """(artist, title, times_used), most used first."""
    counted = edges.groupBy(F.col("dst").alias("artist"), F.col("dst_title").alias("title"))
    used = counted.agg(F.count("*").alias("times_used"))
    return used.orderBy(F.desc("times_used"), "artist", "title")


def degrees(edges: DataFrame) -> DataFrame:
    """(artist, in_degree, out_degree) of every end point, 0 where a side is missing.

    Both degrees come from one scan and one shuffle instead of an outer join.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("dst").alias("artist"), F.lit(1).alias("into"), F.lit(0).alias("out")),
            F.struct(F.col("src").alias("artist"), F.lit(0).alias("into"), F.lit(1).alias("out")),
        )
    )
    return (
        edges.select(ends.alias("e"))
        .groupBy("e.artist")
        .agg(F.sum("e.into").alias("in_degree"), F.sum("e.out").alias("out_degree"))
    )


def known_degrees(edges: DataFrame) -> DataFrame:
    return known(degrees(edges), "artist")


def summary(df: DataFrame, column: str) -> DataFrame:
    """One row: min, max, mean and sample deviation."""
    return df.agg(
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
    )


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: how many reach each of the degree classes."""
    return df.agg(*[F.count_if(F.col(column) >= n).alias(f"at_least_{n}") for n in DEGREE_CLASSES])


def frequency(df: DataFrame, column: str) -> DataFrame:
    """(degree, frequency). Distinct degrees number at most the root of twice the edges."""
    return df.groupBy(F.col(column).alias("degree")).agg(F.count("*").alias("frequency"))


def head_sums(freq: DataFrame, cutoffs: dict[str, Column], per: tuple[str, ...] = ()) -> DataFrame:
    """One row (or one for each value of `per`): degree mass of the top n artists for each n, plus the totals.

    Works on the frequency table: equal degrees are one row, so the running
    count is over few rows and the result does not depend on how ties fall.
    """
    above = Window.partitionBy(*per).orderBy(F.desc("degree")).rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(*per)
    ahead = freq.withColumn("before", F.coalesce(F.sum("frequency").over(above), F.lit(0)))
    ahead = ahead.withColumn("active", F.sum("frequency").over(everyone))
    aggregates = [F.sum(F.col("degree") * F.col("frequency")).alias("total")]
    for name, n in cutoffs.items():
        taken = F.least("frequency", F.greatest(F.lit(0), n - F.col("before")))
        aggregates += [
            F.sum(taken).alias(f"{name}_n"),
            F.sum(F.col("degree") * taken).alias(f"{name}_sum"),
        ]
    return ahead.groupBy(*per).agg(*aggregates)


def both_frequencies(both: DataFrame) -> DataFrame:
    """(direction, degree, frequency) of degrees(artist, in_degree, out_degree), degree 0 included."""
    sides = F.explode(
        F.array(
            F.struct(F.lit("in").alias("direction"), F.col("in_degree").alias("degree")),
            F.struct(F.lit("out").alias("direction"), F.col("out_degree").alias("degree")),
        )
    )
    return both.select(sides.alias("s")).groupBy("s.direction", "s.degree").agg(F.count("*").alias("frequency"))


def concentration_of(both: DataFrame) -> DataFrame:
    """Per direction: edges held by the top 1 % counted over all artists, at least one artist.

    The artists without an edge in a direction are its row of degree 0, so one
    frequency table holds everything.
    """
    cutoff = {"top": at_least_one(F.col("active") * 0.01)}
    return head_sums(both_frequencies(both), cutoff, ("direction",)).select(
        "direction",
        F.col("top_n").alias("artists"),
        F.col("top_sum").alias("edges"),
        percent(F.col("top_sum"), F.col("total")).alias("pct"),
    )


def concentration_all(edges: DataFrame) -> DataFrame:
    return concentration_of(degrees(edges))


def scale_free(edges: DataFrame, above_pct: float = 20.0) -> DataFrame:
    """One row: does the top 1 % receive more than `above_pct` of the edges?"""
    share = concentration_all(edges).where(F.col("direction") == "in")
    return share.select("pct", (F.col("pct") > above_pct).alias("scale_free"))


def concentration_active(edges: DataFrame) -> DataFrame:
    """One row: edge shares of the top 1, 5 and 10 % of the artists that receive any."""
    active = F.col("active")
    cutoffs = {f"top{p}": F.floor(active * (p / 100)) for p in (1, 5, 10)}
    received = edges.groupBy("dst").agg(F.count("*").alias("n"))
    sums = head_sums(frequency(received, "n"), cutoffs)
    return sums.select(
        *[percent(F.col(f"top{p}_sum"), F.col("total")).alias(f"top{p}_pct") for p in (1, 5, 10)]
    )


def power_law(freq: DataFrame) -> DataFrame:
    """One row: least-squares line through the log-log frequency table."""
    x, y = F.log10("degree"), F.log10("frequency")
    fit = freq.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    return fit.withColumn("gamma", F.abs("slope"))


def power_law_curve(freq: DataFrame, points: int = 100) -> DataFrame:
    """(degree, frequency) points of the fitted curve, evenly spaced on the log axis."""
    span = freq.agg(F.log10(F.min("degree")).alias("a"), F.log10(F.max("degree")).alias("b"))
    fit = power_law(freq)
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    line = span.select(
        F.array("a", "b").alias("ab")
    ).select(F.col("ab")[0].alias("a"), F.col("ab")[1].alias("b"), step.alias("point"))
    x = F.col("a") + (F.col("b") - F.col("a")) * F.col("point") / (points - 1)
    slope, intercept = fit.select("slope").scalar(), fit.select("intercept").scalar()
    return line.select(
        "point", F.pow(F.lit(10.0), x).alias("degree"), F.pow(F.lit(10.0), intercept + slope * x).alias("frequency")
    )


def log_histogram(df: DataFrame, column: str, bins: int = 39) -> DataFrame:
    """(bin, count) over log-spaced bins from 1 to the maximum, empty bins included."""
    sizes = df.groupBy(F.col(column).alias("size")).agg(F.count("*").alias("n"))
    top = sizes.agg(F.max("size")).scalar()
    place = F.floor(F.log10("size") / F.log10(top) * bins)
    bucket = F.when(top > 1, F.least(place, F.lit(bins - 1))).otherwise(F.lit(bins - 1))
    filled = sizes.groupBy(bucket.cast("int").alias("bin")).agg(F.sum("n").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").na.fill(0, ["count"])


def hub_table(edges: DataFrame, scores: DataFrame, labels: DataFrame) -> DataFrame:
    """(artist, in_degree, out_degree, authority_score, cluster) of the readable artists."""
    return hubs_of(degrees(edges), scores, labels)


def hubs_of(both: DataFrame, scores: DataFrame, labels: DataFrame) -> DataFrame:
    """The same from degrees(artist, in_degree, out_degree)."""
    hubs = known(both, "artist").where(readable(F.col("artist").cast("string")))
    named = labels.select(F.col("node").alias("artist"), F.col("representative").alias("cluster"))
    scored = hubs.join(scores, "artist", "left")
    return scored.join(named, "artist", "left").select(
        "artist",
        "in_degree",
        "out_degree",
        F.coalesce("authority_score", F.lit(0.1)).alias("authority_score"),
        F.coalesce(F.col("cluster").cast("string"), F.lit("Unknown")).alias("cluster"),
    )


def bridge_score() -> Column:
    """Geometric mean of both degrees: high only for artists strong in both."""
    return F.sqrt(F.col("in_degree") * F.col("out_degree"))


def top_bridges(both: DataFrame, k: int = 15) -> DataFrame:
    scored = both.withColumn("bridge_score", bridge_score())
    return scored.orderBy(F.desc("bridge_score"), "artist").limit(k)


def roles(both: DataFrame) -> DataFrame:
    """Quadrant of each artist against the mean of (degree + 1) in either direction."""
    means = both.agg(F.struct(F.avg(F.col("in_degree") + 1).alias("i"), F.avg(F.col("out_degree") + 1).alias("o"))).scalar()
    gets, gives = F.col("in_degree") + 1 >= means["i"], F.col("out_degree") + 1 >= means["o"]
    role = (
        F.when(gets & gives, "Bridge")
        .when(gets, "Authority")
        .when(gives, "Heavy sampler")
        .otherwise("Peripheral")
    )
    return both.withColumn("role", role)


def self_loop_counts(edges: DataFrame) -> DataFrame:
    """(artist, self_sample_count) of artists that reuse their own work."""
    own = edges.where(F.col("src") == F.col("dst"))
    return own.groupBy(F.col("src").alias("artist")).agg(F.count("*").alias("self_sample_count"))


def self_loop_scores(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """Self-reusing artists with their authority, best first."""
    return (
        spread_join(self_loop_counts(edges), scores, "artist")
        .select("artist", "self_sample_count", "authority_score")
        .orderBy(F.desc("authority_score"), "artist")
    )
