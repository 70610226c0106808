"""From raw documents to packed training sequences, one operator a stage.

The two learned stages fit on labelled rows of the folder's own tables and judge all documents they are given. Every filter hands on
whole rows. The last stage returns the packed pieces with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import decision_list, decontaminate, packing, rule_ensemble, simhash
from tributary.llm.common import whole_row
from tributary.session import discard, handoff, workspace

TOKENIZER = "byte_bpe_50k.json"
#: A document stays if the classifier gives it at least this.
LEAST_SCORE = 0.3


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_row(docs: DataFrame) -> DataFrame:
    """All columns in one, so that none can clash with what a stage computes, beside the text."""
    return docs.select(whole_row(docs).alias("row"), "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = decision_list.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return decision_list.judge(as_row(docs), rules, keep=["row"]).where("kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = rule_ensemble.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rule_ensemble.classify(as_row(docs), model, keep=["row"]).where(F.col("score") >= LEAST_SCORE).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(docs, public_tokenizers.path(TOKENIZER)))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "sequence_id", "offset", "ids", F.crc32("ids").alias("ids_crc32")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL: stages learn models, hash shingles and run a tokenizer. tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each stage's rows are written before the next reads them.

    What a stage wrote for itself is deleted when its rows are written, and its input after that.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with workspace(spark):
            before, docs = docs, handoff(stage(spark, docs, sf_dir), name, keep=True)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
