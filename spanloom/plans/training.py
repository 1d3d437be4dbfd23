"""Annotations to training examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ENTITY_TYPES, NEGATIVE_RATIO, SEED, SPLIT_RATIO
from ..operators.examples import annotation_spans, build_extraction_examples, prompt_examples
from ..operators.regularize import regularize
from ..operators.splits import SPLITS, fill_empty_splits, split_classification, split_extraction
from ..operators.validate import stop_on


def split_annotations(
    annotated: DataFrame,
    key: str = "id",
    entities: Sequence[str] = tuple(ENTITY_TYPES),
    ratio: Sequence[float] = tuple(SPLIT_RATIO),
    seed: int = SEED,
    shuffle: bool = True,
    clean: bool = False,
    text: str = "data.jfull_compress",
) -> DataFrame:
    """``key, split, content, result_list, prompt`` from annotated documents, optionally cleaned first."""
    docs = stop_on(annotation_spans(annotated), strict=True).select(F.col(key), F.col(text).alias("text"), "spans")
    if clean:
        docs = regularize(docs, strict=True)
        docs = docs.drop("reject_reason")
    parts = split_extraction(docs, key, ratio, seed, shuffle)
    return prompt_examples(parts, entities)


def split_corpus(
    corpus: DataFrame, key: str = "id", ratio: Sequence[float] = (), negative_ratio: int = NEGATIVE_RATIO, seed: int = SEED, shuffle: bool = True, **options
) -> DataFrame:
    """Examples of ``key, text, entities, relations`` documents per split; dev and test keep all negatives.

    An empty ratio puts everything into train.
    """
    parts = split_classification(corpus, key, ratio, seed, shuffle)
    if len(ratio) == 0:
        return build_extraction_examples(parts.drop("split"), key, negative_ratio, seed=seed, **options).withColumn("split", F.lit(SPLITS[0]))
    out = None
    for name in SPLITS:
        train = name == SPLITS[0]
        docs = parts.where(F.col("split") == name).drop("split")
        built = build_extraction_examples(docs, key, negative_ratio if train else -1, is_train=train, seed=seed, **options)
        built = built.withColumn("split", F.lit(name))
        out = built if out is None else out.unionByName(built)
    return fill_empty_splits(out)


