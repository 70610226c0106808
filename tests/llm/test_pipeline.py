"""The pipeline on the smallest tables, each stage held against what its operator promises."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontaminate import words
from test_simhash import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = corpus_pipeline.read(spark, FOLDER, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, docs := stage(spark, docs, FOLDER).cache()))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_filters_return_whole_rows(kept):
    for before, after in kept[:-1]:
        assert after.columns == before.columns
        assert after.exceptAll(before).isEmpty()


def test_rules_and_classifier_keep_clean_documents(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in corpus_pipeline.read(spark, FOLDER, "labels").collect()}
    first, second = texts(kept[0][0]), texts(kept[1][1])
    clean = [i for i in first if labels.get(i) == 1 and len(first[i].split()) >= 10]
    junk = [i for i in first if labels.get(i) == 0]
    assert sum(i in second for i in clean) >= 0.95 * len(clean)
    assert sum(i in second for i in junk) <= 0.2 * len(junk)


def test_one_document_of_each_group_stays(kept):
    before, after = texts(kept[2][0]), texts(kept[2][1])
    assert sorted(after) == sorted({c for _, c in brute(before).values()})


def test_decontamination_drops_the_hit_documents_only(spark, kept):
    windows = set()
    for r in corpus_pipeline.read(spark, FOLDER, "benchmark").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    before, after = texts(kept[3][0]), texts(kept[3][1])
    assert sorted(after) == sorted(i for i, t in before.items() if not hit(t))


def test_packed_pieces_hold_every_document(kept):
    docs, packed = kept[4]
    assert Counter(r[0] for r in packed.where("start = 0").select("doc_id").collect()) == Counter(r[0] for r in docs.select("doc_id").collect())
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.where("n != end or n > 2048").isEmpty()


def test_equal_and_null_rows(spark):
    data = [(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (None, None), (None, None), (1, "other words are here")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("key", F.lit("z"))
    once = corpus_pipeline.simhash_near_dedup(spark, docs, FOLDER)
    assert once.columns == docs.columns and once.count() == 3
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).collect()
        stage(spark, docs.limit(0), FOLDER).collect()


def test_odd_column_names_and_maps(spark):
    """Dots, backticks and maps in other columns pass all stages that hand rows on."""
    odd = spark.createDataFrame(
        [(i % 6, f"some words of text number {i % 6} that differ " * 3, {"b": i % 2, "a": 1}, [{"x": None}], "u") for i in range(12)] + [(None, None, None, None, None)],
        "doc_id long, text string, `meta.url` map<string,int>, `a``b` array<map<string,string>>, `row.id` string",
    )
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, FOLDER)
        assert got.collect() is not None
        if name != "best_fit_packing":
            assert got.columns == odd.columns
    assert corpus_pipeline.simhash_near_dedup(spark, odd.select("doc_id", "text", "`a``b`"), FOLDER).count() == 7
