"""Writing results and skipping stages whose results are there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


#: Quotes are doubled and blanks at the ends are kept, so that any text comes back as it was.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; null is an empty field, empty text a pair of quotes."""
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What write_csv has written, line ends inside texts included. An empty field is null; only a text of a single NUL is lost to it."""
    return spark.read.options(**CSV, multiLine=True, nullValue="\0").schema(schema).csv(path)


def write_alias_map(aliases: DataFrame, path: str) -> None:
    """JSON lines, one entry per line."""
    line = F.to_json(F.struct("variant", "canonical")).alias("value")
    aliases.select(line).write.mode("overwrite").text(path)


#: What a bundle holds; every kind has its folder, also without a row.
KINDS = ("node", "link", "cluster")


def write_bundle(bundle: DataFrame, path: str) -> None:
    """Rows of (kind, json) as one folder of JSON lines per kind."""
    bundle.select("kind", F.col("json").alias("value")).write.mode("overwrite").partitionBy("kind").text(path)
    # Spark makes no folder for a kind without rows, and readers of that kind would fail
    spark = bundle.sparkSession
    for kind in KINDS:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kind={kind}")
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


#: Beside a result: what it was computed from. Spark's readers pass over names that start like this.
MANIFEST = "_manifest"


def is_complete(spark: SparkSession, path: str, manifest: str | None = None) -> bool:
    """Did a job finish writing this folder, from what `manifest` stands for?"""
    if not exists(spark, f"{path}/_SUCCESS"):
        return False
    return manifest is None or (exists(spark, f"{path}/{MANIFEST}") and recalled(spark, path) == manifest)


def remember(spark: SparkSession, path: str, manifest: str) -> None:
    """Put the manifest beside a finished result."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    stream.writeBytes(manifest)
    stream.close()


def recalled(spark: SparkSession, path: str) -> str:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def forget(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, False)


def listing(spark: SparkSession, *paths: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of the last change) of all files in these folders, or of these files."""
    found = []
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def read_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame], manifest: str | None = None) -> DataFrame:
    """The table at `path`, computed and written first unless it is there already, from what `manifest` stands for."""
    if not is_complete(spark, path, manifest):
        write_table(compute(), path)
        if manifest is not None:
            remember(spark, path, manifest)
    return spark.read.parquet(path)


def require(spark: SparkSession, *paths: str) -> None:
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"run the earlier stages first: {', '.join(missing)}")


def preview(df: DataFrame, k: int = 20) -> DataFrame:
    """The first k rows in the table's own order."""
    return df.limit(k)
