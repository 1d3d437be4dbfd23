"""Whole jobs over files: annotations to training files, evaluation to metric files, two result files to one table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LABEL_THRESHOLD, MAX_SEQ_LEN, NEGATIVE_RATIO, PAIR_SEPARATOR, PROMPT_OPTIONS, PROMPT_PREFIX, SEED, SPLIT_RATIO
from ..functions.common import seeded_hash
from ..functions.labels import decode_logits
from ..functions.rules import Rule, rule_spans
from ..operators.chunk import chunk_examples
from ..operators.examples import annotation_choices, annotations_to_corpus, classification_examples, label_examples
from ..operators.merge import expand_labels, merge_results
from ..operators.metrics import multilabel_metrics, span_metrics
from ..operators.splits import SPLITS, fill_empty_splits, split_classification
from ..operators.validate import accepted
from ..session import durable
from ..sources.readers import label_list, read_annotations, read_flat_table, read_prompt_examples, read_results
from ..sources.writers import write_csv, write_json, write_splits
from .training import split_corpus


def shuffled(df: DataFrame, columns: Sequence[str], seed: int | str = SEED) -> DataFrame:
    """The rows in a repeatable random order that follows from the columns, which name a row."""
    order = seeded_hash(seed, *[F.col(f"`{c}`") for c in columns])
    return df.orderBy(order, *[F.col(f"`{c}`") for c in columns])


def prepare_labels(
    spark: SparkSession, annotations: str, labels: str, out: str, ratio: Sequence[float] = tuple(SPLIT_RATIO), seed: int = SEED, shuffle: bool = True,
    separator: str = PAIR_SEPARATOR, key: str = "id", lines: bool = False,
) -> None:
    """Annotated choices to label examples, JSON lines in one folder per split.

    An empty train split takes the rows of dev, or else of test, an empty dev split those of test. A label that the
    vocabulary file lacks stops the job; a document without results has no labels.
    """
    vocabulary = label_list(spark, labels)
    documents = annotation_choices(read_annotations(spark, annotations, lines))
    examples = label_examples(documents, vocabulary, "text", "label", separator, strict=True)
    parts = durable(split_classification(examples.select(key, "text_a", "text_b", "question", "choices", "labels"), key, ratio, seed, shuffle))
    write_splits(fill_empty_splits(parts).drop(key), out)


def prepare_corpus(
    spark: SparkSession, annotations: str, out: str, task: str = "ext", ratio: Sequence[float] = (), negative_ratio: int = NEGATIVE_RATIO, seed: int = SEED, shuffle: bool = True,
    prefix: str = PROMPT_PREFIX, options: Sequence[str] = tuple(PROMPT_OPTIONS), key: str = "id", lines: bool = False, **extraction,
) -> None:
    """Annotations to prompt examples, JSON lines in one folder per split.

    ``task`` is ``ext`` for spans and relations with their negatives, or ``cls`` for chosen classes. With ``shuffle``
    documents are split in random order and the training examples come in random order.
    """
    if task not in ("ext", "cls"):
        raise ValueError(f"task is ext or cls, not {task}")
    documents = read_annotations(spark, annotations, lines)
    if task == "ext":
        corpus = annotations_to_corpus(documents.withColumnRenamed(key, "__key"), "__key").drop("__key")
        examples = split_corpus(corpus, "id", ratio, negative_ratio, seed, shuffle, prefix=prefix, options=options, **extraction)
        names = ["id", "kind", "prompt"]
    else:
        chosen = annotation_choices(documents).select(key, "text", "label")
        parts = chosen.withColumn("split", F.lit(SPLITS[0])) if len(ratio) == 0 else split_classification(chosen, key, ratio, seed, shuffle)
        built = [classification_examples(parts.where(F.col("split") == s), key, prefix=prefix, options=options, seed=seed).withColumn("split", F.lit(s)) for s in SPLITS]
        examples = durable(built[0].unionByName(built[1]).unionByName(built[2]))
        examples = examples if len(ratio) == 0 else fill_empty_splits(examples)
        names = [key, "prompt"]
    if shuffle:
        examples = shuffled(examples, names, seed)
    write_splits(examples.select("content", "result_list", "prompt", "split", *(["kind"] if "kind" in examples.columns else [])), out)


def rule_predictions(rules: Mapping[str, Rule], probability: Callable[[Column], Column] | None = None, threshold: float = 0.0) -> Callable[[DataFrame], DataFrame]:
    """A predictor that finds the spans of each row's prompt by rules."""

    def predict(rows: DataFrame) -> DataFrame:
        found = rule_spans(F.col("content"), rules, *([probability] if probability else []))
        mine = F.filter(found, lambda s: (s["entity"] == F.col("prompt")) & (s["probability"] > threshold))
        return rows.withColumn("predicted", mine)

    return predict


def evaluate_spans(
    spark: SparkSession, examples: str, predict: Callable[[DataFrame], DataFrame], out: str, max_seq_len: int = MAX_SEQ_LEN, by_class: bool = False, classes: Sequence[str] | None = None
) -> None:
    """Prompt examples, cut into chunks and predicted, to precision, recall and F1 as JSON: in total, or by prompt and in total.

    ``predict`` adds ``predicted`` (spans within the chunk) to ``content, prompt``. With ``classes`` a prompt that is none of them stops the job.
    """
    chunks = accepted(chunk_examples(read_prompt_examples(spark, examples), max_seq_len))
    if classes is not None:
        known = F.col("prompt").isin(list(classes))
        chunks = chunks.where(F.when(known, True).otherwise(F.raise_error(F.concat(F.lit("Unknown entity: "), F.col("prompt"))).cast("boolean")))
    scored = predict(chunks).select(F.col("prompt").alias("entity"), F.col("result_list").alias("gold"), "predicted")
    write_json(span_metrics(scored, by="entity" if by_class else None), out)


def evaluate_labels(rows: DataFrame, out: str, n_labels: int, key: str = "id", logits: str = "logits", truth: str = "labels", threshold: float = LABEL_THRESHOLD) -> None:
    """Logits and true labels to ``metrics`` and ``predictions`` under ``out``: chosen labels with their probabilities."""
    decoded = durable(rows.select(F.col(key).alias("id"), F.col(truth).alias("truth"), decode_logits(F.col(logits), threshold).alias("hits")))
    chosen = F.transform("hits", lambda h: h["label"])
    write_json(decoded.select("id", chosen.alias("labels"), F.transform("hits", lambda h: h["prob"]).alias("probs")), f"{out}/predictions")
    flags = F.transform(F.sequence(F.lit(0), F.lit(n_labels - 1)), lambda i: F.array_contains(F.transform(chosen, lambda x: x.cast("int")), i).cast("int"))
    write_json(multilabel_metrics(decoded.withColumn("flags", flags), n_labels, "truth", "flags"), f"{out}/metrics")


def merge_files(spark: SparkSession, table: str, results: str, out: str, labels: Sequence[str], result_schema: str, lines: bool = False) -> None:
    """A flat CSV table and label results in JSON, joined on all their common columns, to CSV with a byte order mark.

    Sides of different lengths, or a join of another length, stop the job before anything is written.
    """
    right = expand_labels(read_results(spark, results, result_schema, lines), labels)
    write_csv(merge_results(read_flat_table(spark, table), right), out, bom=True)
