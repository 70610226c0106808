"""From catalogue tables to the song-level reuse graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.text import clean_name, strip_featured
from tributary.operators.aliases import apply_aliases
from tributary.operators.links import UNKNOWN, drop_placeholders, link_weight
from tributary.operators.skew import Chain, fits_broadcast, spread_join
from tributary.session import cut, side_by_side
from tributary.sources.dumps import read_dump

# Relation types that mean reuse, and those that count in full.
REUSE_TYPES = [69, 231, 230, 232, 227]
FULL_TYPES = [69, 231]

TABLES = [
    "recording", "artist", "artist_credit_name", "link", "l_recording_recording",
    "track", "medium", "release", "release_group_meta",
]


def load_dump(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: read_dump(spark, path, name) for name in TABLES}


def main_credits(names: DataFrame, artists: DataFrame) -> DataFrame:
    """credits(id, name, gid): the first-named artist of every credit, guests cut off.

    One artist may be named in a third of the credits, hence the spread join.
    """
    return credits_of(names, short_names(artists))


def short_names(artists: DataFrame) -> DataFrame:
    """artists(id, name, gid) with guests cut off the name."""
    return artists.select("id", strip_featured(F.col("name")).alias("name"), "gid")


def credits_of(names: DataFrame, artists: DataFrame) -> DataFrame:
    first = names.where(F.col("position") == 0).select(F.col("artist_credit").alias("id"), "artist")
    return spread_join(first, artists.withColumnRenamed("id", "artist"), "artist").select("id", "name", "gid")


def dated_tracks(track: DataFrame, medium: DataFrame, release: DataFrame, meta: DataFrame) -> tuple[Chain, DataFrame]:
    """Tracks(recording, medium) to be joined, and media(medium, year); the chain of releases is resolved from its short end."""
    groups = meta.select(F.col("id").alias("release_group"), F.col("first_release_date_year").alias("year"))
    releases = spread_join(
        release.select(F.col("id").alias("release"), "release_group"), groups, "release_group"
    ).drop("release_group")
    media = spread_join(medium.select(F.col("id").alias("medium"), "release"), releases, "release").drop("release")
    media = cut(media)  # its true size decides how it is joined
    dated = Chain(track.select("recording", "medium"), "medium")
    if not fits_broadcast(media):
        dated.hot(["medium"])
    return dated, media


def release_years(track: DataFrame, medium: DataFrame, release: DataFrame, meta: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """years(recording, release_year): the first year any release of a recording came out; `only` these recordings (id).

    The chain is resolved from its short end, so the tracks, by far the longest
    table, are joined once. Any parent may own a third of the rows below it.
    """
    return years_of(*dated_tracks(track, medium, release, meta), only)


def years_of(dated: Chain, media: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """The same from dated_tracks. A short list of recordings thins the tracks out first; a long one would move
    them all once more, so it meets the years, one row per recording, instead."""
    kept = None if only is None else only.select(F.col("id").alias("recording"))
    few = kept is not None and fits_broadcast(kept)
    if few:
        dated.join(kept, "recording")
    years = dated.join(media, "medium").df.groupBy("recording").agg(F.min("year").alias("release_year"))
    return years if kept is None or few else years.join(kept, "recording", "left_semi")


def reuse_edges(relations: DataFrame, link: DataFrame) -> DataFrame:
    """edges(source_song_id, target_song_id, weight) of the reuse relations."""
    kinds = link.where(F.col("link_type").isin(REUSE_TYPES)).select(
        F.col("id").alias("link"),
        link_weight(F.col("link_type"), FULL_TYPES, REUSE_TYPES).alias("weight"),
    )
    return spread_join(relations.select("link", "entity0", "entity1"), kinds, "link").select(
        F.col("entity0").alias("source_song_id"), F.col("entity1").alias("target_song_id"), "weight"
    )


def song_info(recording: DataFrame, credits: DataFrame, years: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """songs(id, title, name, gid, year): one row per recording with a credited artist; `only` these recordings (id).

    Both ends of an edge need the same facts, so they are put together once per
    song instead of once per end of every edge.
    """
    songs = Chain(recording.select("id", F.col("name").alias("title"), "artist_credit"), "id", "artist_credit")
    if only is not None:
        songs.join(only.select("id"), "id")
    credited = songs.join(credits.withColumnRenamed("id", "artist_credit"), "artist_credit").df.drop("artist_credit")
    return credited.join(
        years.select(F.col("recording").alias("id"), F.col("release_year").alias("year")), "id", "left"
    )


def enrich(edges: DataFrame, songs: DataFrame) -> DataFrame:
    """Put both songs' facts on every edge; edges to songs without facts are dropped."""

    def side(prefix: str, key: str) -> DataFrame:
        return songs.select(
            F.col("id").alias(key),
            F.col("name").alias(f"{prefix}_Artist_Name"),
            F.col("gid").alias(f"{prefix}_Artist_GID"),
            F.col("title").alias(f"{prefix}_Song_Title"),
            F.col("year").alias(f"{prefix}_Release_Year"),
        )

    both = Chain(edges, "source_song_id", "target_song_id")
    both.join(side("Sampler", "source_song_id"), "source_song_id").join(side("Original", "target_song_id"), "target_song_id")
    return both.df.select(
        "source_song_id", "target_song_id", "weight",
        "Sampler_Artist_Name", "Sampler_Artist_GID", "Sampler_Song_Title", "Sampler_Release_Year",
        "Original_Artist_Name", "Original_Artist_GID", "Original_Song_Title", "Original_Release_Year",
    )


def keep_real(graph: DataFrame) -> DataFrame:
    """Drop edges within one artist (by GID) and edges of unknown artists."""
    names = ["Sampler_Artist_Name", "Original_Artist_Name"]
    other = graph.where(F.col("Sampler_Artist_GID") != F.col("Original_Artist_GID"))
    for n in names:
        other = other.where(F.col(n) != UNKNOWN)
    return drop_placeholders(other, *names)


def resolved(artists: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """artists(id, name, gid) by their final names: a name is resolved once per artist, not once per credit."""
    artists = short_names(artists)
    return artists.withColumn("name", clean_name(F.col("name"))) if aliases is None else apply_aliases(artists, aliases)


def build_graph(tables: dict[str, DataFrame], aliases: DataFrame | None = None) -> DataFrame:
    """The reuse graph with the names, GIDs, titles and years of both ends."""

    def reused() -> tuple[DataFrame, DataFrame]:
        edges = cut(reuse_edges(tables["l_recording_recording"], tables["link"]))
        ends = F.explode(F.array("source_song_id", "target_song_id")).alias("id")
        return edges, cut(edges.select(ends).distinct())

    # Few songs take part in any reuse; only their facts are looked up.
    spark = tables["track"].sparkSession
    credits, (edges, used), tracks = side_by_side(
        spark, lambda: credits_of(tables["artist_credit_name"], resolved(tables["artist"], aliases)), reused,
        lambda: dated_tracks(*(tables[t] for t in ("track", "medium", "release", "release_group_meta"))),
    )
    # Both ends read the facts, and their true size decides how they are joined.
    songs = cut(song_info(tables["recording"], credits, years_of(*tracks, used), used))
    return keep_real(enrich(edges, songs))
