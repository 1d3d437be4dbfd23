"""The pipeline on awkward rows, stage by stage, and the registered queries on the given tables."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from spanloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = entry.queries()
    assert {*QUERIES, "pipeline"} <= set(names)
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, None, None, None, None), (100_001, None, "en", "s", 0), (100_002, "", "en", "s", 0), (100_002, "", "en", "s", 0)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, seen, FOLDER))
        assert kept.columns == COLUMNS, name
        assert kept.exceptAll(seen).count() <= 4, name  # a NULL text may come back empty
        assert 0 < kept.count() <= seen.count(), name
        seen = kept
    assert seen.groupBy(F.coalesce("text", F.lit(""))).count().filter("count > 1").count() == 0
    packed = corpus_pipeline.pack(spark, seen, FOLDER)
    assert packed.select("doc_id").distinct().count() == seen.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_stages_on_no_rows(spark):
    none = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0, name


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_exact_dedup_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    sql = con.sql(entry.oracle_sql()["op2_exact_dedup"]).df()
    got = QUERIES["op2_exact_dedup"](spark, FOLDER).toPandas()
    order = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got[order].values.tolist())) == sorted(map(tuple, sql[order].values.tolist()))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_stages_with_clashing_columns(spark):
    clash = ["score", "gone_key", "leak_key", "row_key", "root", "kept_0", "row", "body", "item_id", "code"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 60")
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in clash])
    plain = docs.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in clash), name
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in stage(spark, plain, FOLDER).collect()), name
    assert corpus_pipeline.pack(spark, docs, FOLDER).count() >= docs.count()
