"""Reading the catalogue dump, Parquet tables, alias maps and short lists."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import share_code

# The columns of the dump files in file order. Files may hold
# more columns to the right; the reader ignores them.
SCHEMAS = {
    "recording": "id int, gid string, name string, artist_credit int, length int, comment string, "
    "edits_pending int, last_updated string, video string",
    "artist_credit": "id int, artist_count int, name string, edits_pending int",
    "artist": "id int, gid string, name string, sort_name string",
    "artist_credit_name": "artist_credit int, position int, artist int, name string, join_phrase string",
    "link": "id int, link_type int, begin_date_year string, begin_date_month string, "
    "begin_date_day string, end_date_year string, end_date_month string, end_date_day string, "
    "attribute_count int, created string, ended string",
    "l_recording_recording": "id int, link int, entity0 int, entity1 int, edits_pending int, "
    "last_updated string, link_order int",
    "track": "id int, gid string, recording int, medium int",
    "medium": "id int, release int",
    "release": "id int, gid string, name string, artist_credit int, release_group int",
    "release_group_meta": "id int, release_count int, first_release_date_year int",
}


def read_dump(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One headerless tab-separated dump file; `\\N` is null and quotes are plain characters."""
    reader = spark.read.schema(SCHEMAS[name]).option("sep", "\t").option("nullValue", "\\N")
    # Titles may start with a quote that never closes; as a quote character it
    # would swallow the following columns.
    return reader.option("quote", "").csv(f"{path}/{name}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """(variant, canonical) from JSON lines or from files that are one JSON object each.

    Lines are taken if every line that is not blank is an object with exactly the
    keys `variant` and `canonical`, in any order and spacing; a generated map may have any
    number of them. Otherwise each file must be one object of variant to canonical, as people
    keep it; the last of equal keys counts, as usual in JSON. Anything else raises when it is
    read: a map taken in part would rename artists silently. Blank files are an empty map.
    """
    entry = F.from_json("value", "map<string,string>")
    lines = spark.read.text(path).where(F.trim("value") != "").select(entry.alias("e"))
    fits = (F.size("e") == 2) & F.col("e.variant").isNotNull() & F.col("e.canonical").isNotNull()
    seen = lines.agg(F.count("*").alias("all"), F.count_if(fits).alias("entries")).first()
    if seen["all"] == seen["entries"]:
        return lines.select("e.variant", "e.canonical")
    share_code(spark)
    files = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    return files.mapInPandas(alias_objects, "variant string, canonical string")


def alias_objects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for text in batch["value"]:
            found = json.loads(text)  # the whole text must be one value
            if not isinstance(found, dict) or not all(isinstance(v, str) for v in found.values()):
                raise ValueError("an alias map is neither lines of variant and canonical nor one object of names")
            yield pd.DataFrame(list(found.items()), columns=["variant", "canonical"])


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A short list of literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def ranked_names(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(ground_truth, ground_truth_rank) from names in rank order."""
    rows = [(name, place) for place, name in enumerate(names, start=1)]
    return from_rows(spark, rows, "ground_truth string, ground_truth_rank int")
