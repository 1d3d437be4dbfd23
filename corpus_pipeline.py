"""The corpus pipeline: quality, exact and near duplicates, benchmark passages, packed sequences.

Each stage takes what the one before kept and returns the columns of ``documents``, the last the places of the
pieces. ``run`` writes each stage's result to the shared folder and reads it again.

Rows with NULLs, empty or very long texts, ties, repeated rows, empty tables and further columns are handled as the
operators of each stage state; further columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import spanloom
from spanloom.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from spanloom.llm.common import table, written
from spanloom.llm.queries import id_remainder, vocabulary

# Executors get the functions with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(spanloom)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the quality cut, learnt from the labels that are not held out."""
    may_learn = F.coalesce(id_remainder(5) != 0, F.lit(False))
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"), may_learn, threshold=0.3)
    # Further columns pass under names of their own, whatever they are called.
    names = [c if c == "text" else f"kept_{n}" for n, c in enumerate(docs.columns)]
    scored = quality.scored(docs.toDF(*names).withColumn("text", F.coalesce("text", F.lit(""))), model)
    return scored.filter("score >= 0.3").select(*names).toDF(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the one with the smallest id."""
    return exact_dedup.exact_distinct(docs, keep="smallest")


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles the one with the smallest id."""
    return jaccard_join.without_similar(docs, size=5, share=80)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 4,096 ids."""
    return packing.packed_documents(docs, vocabulary("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", keep_distinct),
    ("ngram_jaccard_join", keep_dissimilar),
    ("benchmark_decontamination", keep_clean),
    ("packing", pack),
]

#: A learnt model and a tokenizer are beyond SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
