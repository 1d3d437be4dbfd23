"""The registered queries of the numbered operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, hard_negatives, jaccard_join, line_dedup, lm_score, packing, quality, sharding, substring_dedup, token_files, warc, whitening
from .common import id_and_text, table


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4,096 ids."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2, capacity=4096)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts; the largest id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def id_remainder(divisor: int):
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts; those with remainder 2 are held out."""
    return lm_score.scores(table(spark, sf_dir, "documents"), held_out=id_remainder(7) == 2)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles overlap by 85 %."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"), size=4, share=85)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold benchmark passages, also with other numbers and names."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards near equal in bytes, by virtual slots."""
    rows = sharding.sharded(table(spark, sf_dir, "documents"), shards=24)
    return rows.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that windows of 13 words repeat from documents with smaller ids."""
    rows = substring_dedup.removed_spans(table(spark, sf_dir, "documents"), block=7, window=13, digest=True)
    return rows.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores; labels with remainder 0 are held out."""
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(id_remainder(5) == 0, F.lit(False))
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"), may_learn=~held_out, threshold=0.3)
    rows = quality.scored(id_and_text(docs), model)
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written as Parquet lists and read back."""
    path = token_files.token_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_files.id_checksums(token_files.read_token_files(spark, path))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages, written as WARC files and read back."""
    path = warc.record_folder(spark)
    warc.write_records(warc.derived(warc.responses(table(spark, sf_dir, "pages"), date="2024-01-01T00:00:00Z")), path)
    return warc.read_records(spark, path).withColumn("block_sha256", F.sha2("block", 256)).drop("block")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that at least 5 documents hold stay in the largest id only."""
    rows = line_dedup.deduplicated_lines(table(spark, sf_dir, "documents"), least_chars=40, documents=5)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of all embeddings."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000, weights="counts")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), anchors=F.col("vec_id") % 100 == 0, label=label, positives=5, negatives=10, low=30, high=90, scale=256)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_exact_dedup, op3_lm_score, op4_jaccard_join, op5_decontamination, op6_sharding, op7_substring_dedup, op8_quality, op9_token_files, op10_warc,
        op11_line_dedup, op12_whitening, op13_hard_negatives,
    )
}
