from conftest import rows
from pyspark.sql import functions as F

from tributary.llm.common import fold_bucket, hash_sample


def test_sample_is_bounded_and_repeats_itself(spark):
    df = spark.range(50_000).select((F.col("id") % 20_000).alias("a"), F.lit("x").alias("b"))
    once = rows(hash_sample(df, 500))
    assert len(once) == len(set(once)) == 500
    assert rows(hash_sample(df.repartition(7), 500)) == once
    assert len(rows(hash_sample(df, 30_000))) == 20_000
    hot = df.where("a = 3").unionByName(df.where("a < 10"))
    assert len(rows(hash_sample(hot, 500))) == 10
    assert rows(hash_sample(df.limit(0), 5)) == []


def test_fold_of_ids(spark):
    import zlib

    df = spark.createDataFrame([(1,), (25,), (None,)], "doc_id long").select("doc_id", fold_bucket("doc_id", 10))
    assert rows(df) == sorted([(1, zlib.crc32(b"1") % 10), (25, zlib.crc32(b"25") % 10), (None, 0)], key=repr)
