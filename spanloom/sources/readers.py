"""Readers with explicit schemas. JSON documents may be one object, an array or one object per line."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ERROR_EXTENSION, ERROR_NO_DATA, TEXT_COLUMN
from ..functions.text import strip_text
from ..schemas import ANNOTATED, CORPUS_EXPORT_RAW, CORPUS_LABEL_OBJECT, ENTITIES, LABEL_EXAMPLE_RAW, PROMPT_EXAMPLE, RELATIONS, VERDICT


def _require_rows(df: DataFrame, path: str | Sequence[str]) -> DataFrame:
    if df.isEmpty():
        raise ValueError(ERROR_NO_DATA.format(path=path))
    return df


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores; a scan with enough splits is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_json(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, lines: bool = False) -> DataFrame:
    """Objects, arrays of objects (``lines=False``) or JSON lines, which are read in parallel also within a file."""
    reader = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return _require_rows(reader.json(path), path)


def read_annotations(spark: SparkSession, path: str | Sequence[str], lines: bool = False, schema: str = ANNOTATED) -> DataFrame:
    """Exports of the annotation tool."""
    return read_json(spark, path, schema, lines)


def read_documents(spark: SparkSession, path: str, lines: bool = False, schema: str | None = None, text: str = TEXT_COLUMN) -> DataFrame:
    """Documents from ``.json`` (all keys kept) or ``.txt`` (one document per line, stripped)."""
    extension = "." + path.rsplit(".", 1)[-1] if "." in path.rsplit("/", 1)[-1] else ""
    if extension == ".txt":
        return spark.read.text(path).select(strip_text(F.col("value")).alias(text))
    if extension == ".json":
        return read_json(spark, path, schema, lines)
    raise ValueError(ERROR_EXTENSION.format(extension=extension))


def verdict_schema() -> str:
    return VERDICT


def documents_from_list(spark: SparkSession, texts: Iterable[str], text: str = TEXT_COLUMN) -> DataFrame:
    return spark.createDataFrame([(t,) for t in texts], f"`{text}` string")


def read_prompt_examples(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.schema(PROMPT_EXAMPLE).json(path)


def read_label_examples(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """One JSON lines file, or every file of a folder whose name ends with ``suffix``."""
    reader = spark.read.schema(LABEL_EXAMPLE_RAW)
    if suffix is not None:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.json(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``label_id, label`` in file order. A vocabulary is a small file, read whole to keep its order."""
    lines = F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n", -1)
    return spark.read.text(path, wholetext=True).select(F.posexplode(lines).alias("label_id", "label")).withColumn("label", strip_text(F.col("label")))


def label_list(spark: SparkSession, path: str) -> list[str]:
    return [r["label"] for r in read_labels(spark, path).orderBy("label_id").collect()]


def read_results(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, lines: bool = False) -> DataFrame:
    """Saved inference results."""
    return read_json(spark, path, schema, lines)


def read_flat_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A flat result table; a byte order mark in the header is dropped."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def normalize_corpus(df: DataFrame) -> DataFrame:
    """``text, entities, relations`` from any of four export layouts; ids count from 0 per document in list layouts."""
    pairs = F.from_json(F.col("label"), "array<array<string>>")
    nested = F.from_json(F.col("label"), CORPUS_LABEL_OBJECT)
    is_list = F.startswith(F.ltrim(F.col("label")), F.lit("["))
    from_list: Column = F.transform(
        pairs,
        lambda x, i: F.struct(
            i.cast("bigint").alias("id"), F.get(x, F.lit(2)).alias("label"),
            F.get(x, F.lit(0)).cast("int").alias("start_offset"), F.get(x, F.lit(1)).cast("int").alias("end_offset"),
        ),
    )
    entities = F.when(is_list, from_list.cast(ENTITIES)).otherwise(F.coalesce(nested["entities"], F.col("entities")))
    relations = F.when(~is_list, nested["relations"]).otherwise(F.lit(None).cast(RELATIONS))
    relations = F.when(F.col("label").isNull(), F.col("relations")).otherwise(relations)
    others = [c for c in df.columns if c not in {"data", "text", "label", "entities", "relations"}]
    return df.select(
        *others,
        F.coalesce("data", "text").alias("text"),
        F.coalesce(entities, F.array().cast(ENTITIES)).alias("entities"),
        F.coalesce(relations, F.array().cast(RELATIONS)).alias("relations"),
    )


def read_corpus_export(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON lines of a text-annotation export, normalised."""
    return normalize_corpus(spark.read.schema(CORPUS_EXPORT_RAW).json(path))


def read_splits(spark: SparkSession, paths: Mapping[str, str], reader=read_label_examples) -> DataFrame:
    """Several split files as one frame with a ``split`` column, so that one job handles them all."""
    parts = [reader(spark, path).withColumn("split", F.lit(name)) for name, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
