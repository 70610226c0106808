"""URL filters whose lists change over time.

A list is a log of dated entries: a pattern is added or removed. Each addition is valid until the pattern's next entry in the same list, so
the log becomes validity intervals. Every capture is then held, as of its fetch date, against the intervals of all patterns that cover its
URL. Of the active ones the most specific decides: a longer path before a shorter, any path before a domain, a longer domain before a shorter; of
equally specific ones a denial before a permission, then the smaller list name.

Patterns: `domain` covers a host and all hosts below it, `prefix` covers a host and path up to a whole path segment. Hosts
are compared in lower case without user, port and last dot. A URL is turned into the keys that could be listed: only
depths that occur in the list are tried, so a URL of a thousand segments has no more keys than the list has depths.

An entry with a null in pattern, action or date is ignored; of several entries for one pattern and date a removal wins, and equal ones
count once. A capture without a host or a fetch date is unlisted. Repeated captures stay repeated, other columns are not read.
Empty tables give an empty result or unlisted captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADD, REMOVE = "add", "remove"


def host_of(url: str) -> Column:
    """Host of a URL column; empty if there is none."""
    whole = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.regexp_replace(whole, r"\.+$", ""))


def path_of(url: str) -> Column:
    """Path of a URL column without slashes at its ends."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "^/+|/+$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """(key, kind, depth, pattern, list, deny, since, until) from entries (list, kind, pattern, action, verdict, at).

    `since` is included, `until` (null: still valid) is not. A pattern has one
    row per date at most before the window, however often it was logged.
    """
    pattern = F.regexp_replace(F.lower(F.regexp_extract("pattern", "^[^/]*", 0)), r"\.+$", "")
    rest = F.regexp_replace(F.regexp_extract("pattern", "^[^/]*(.*)$", 1), "^/+|/+$", "")
    whole = F.when((F.col("kind") == "prefix") & (rest != ""), F.concat(pattern, F.lit("/"), rest)).otherwise(pattern)
    known = entries.where(
        F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("action").isin(ADD, REMOVE) & F.col("kind").isin("domain", "prefix")
    ).withColumn("pattern", whole)
    per_date = known.groupBy("list", "kind", "pattern", "at").agg(
        F.min(F.col("action") == ADD).alias("adds"),
        F.max(F.when(F.col("action") == ADD, F.col("verdict") == "deny")).alias("deny"),
    )
    following = Window.partitionBy("list", "kind", "pattern").orderBy("at")
    depth = F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\."))).otherwise(F.size(F.split("pattern", "/")) - 1)
    return (
        per_date.withColumn("until", F.lead("at").over(following)).where("adds")
        .select(
            F.concat_ws(":", "kind", "pattern").alias("key"), "kind", depth.alias("depth"), "pattern", "list",
            F.coalesce("deny", F.lit(False)).alias("deny"), F.col("at").alias("since"), "until",
        )
    )


def keys_of(domains: list[int], prefixes: list[int]) -> Column:
    """The keys of a capture (columns host, path) at the depths that are listed."""
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    count, deep = F.size(labels), F.when(F.col("path") == "", 0).otherwise(F.size(segments))
    keys = [
        F.when(count >= d, F.concat(F.lit("domain:"), F.array_join(F.slice(labels, F.greatest(count - d + 1, F.lit(1)), F.lit(d)), ".")))
        for d in domains
    ] + [
        F.when(deep >= d, F.concat(F.lit("prefix:"), F.concat_ws("/", F.col("host"), F.array_join(F.slice(segments, 1, d), "/")) if d else F.col("host")))
        for d in prefixes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def judge(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched"
) -> DataFrame:
    """One row per capture: id, url, fetched, verdict (deny, allow or unlisted), pattern, list, since."""
    valid = intervals(entries)
    # depths are few: labels of a host, segments of a listed path
    depths = valid.groupBy("kind").agg(F.array_sort(F.collect_set("depth")).alias("d")).collect()
    depths = {r["kind"]: r["d"] for r in depths}
    given = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(at_col).alias("fetched"),
    ).withColumns({"host": host_of("url"), "path": path_of("url")})
    keys = F.when(F.col("host") != "", keys_of(depths.get("domain", []), depths.get("prefix", [])))
    # the first key carries the capture itself; one without keys has a null key, which matches nothing
    tried = given.select("row", "id", "url", "fetched", F.posexplode_outer(keys).alias("n", "key"))
    first = F.coalesce(F.col("n"), F.lit(0)) == 0
    light = tried.select(
        "row", "key", F.col("fetched").alias("asof"), F.when(first, F.struct("id", "url", "fetched")).alias("capture")
    )
    sides = valid.select("key", "kind", "depth", "pattern", "list", "deny", "since", "until")
    active = (F.col("c.key") == F.col("v.key")) & (F.col("asof") >= F.col("since")) & (F.col("until").isNull() | (F.col("asof") < F.col("until")))
    found = light.alias("c").join(sides.alias("v"), active, "left")
    # the smallest of these decides
    rank = F.struct(
        F.when(F.col("kind") == "prefix", 0).otherwise(1).alias("a"), (-F.col("depth")).alias("b"), (~F.col("deny")).alias("c"),
        F.col("list"), F.col("pattern"), F.col("since"),
    )
    best = found.groupBy("row").agg(F.max("capture").alias("capture"), F.min(F.when(F.col("v.key").isNotNull(), rank)).alias("best"))
    verdict = F.when(F.col("best").isNull(), "unlisted").when(F.col("best.c"), "allow").otherwise("deny")
    return best.select("capture.*", verdict.alias("verdict"), "best.pattern", "best.list", "best.since")
