"""Label vocabularies: indexes, multi-hot vectors, decoding of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LABEL_THRESHOLD
from .common import let, str_array


def label_index(name: Column, labels: Sequence[str]) -> Column:
    """0-based id of a label, NULL when it is not in the vocabulary."""
    at = F.array_position(str_array(labels), name)
    return F.when(at > 0, at - 1).cast("int")


def label_indexes(names: Column, labels: Sequence[str]) -> Column:
    return F.transform(names, lambda n: label_index(n, labels))


def unknown_labels(names: Column, labels: Sequence[str]) -> Column:
    return F.array_except(names, str_array(labels))


def multi_hot(indexes: Column, size: Column | int) -> Column:
    """0/1 vector with ones at ``indexes``; negative indexes count from the end."""
    n = F.lit(size) if isinstance(size, int) else size
    return let(
        indexes,
        lambda ones: F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.when(F.array_contains(ones, i) | F.array_contains(ones, i - n), F.lit(1.0)).otherwise(F.lit(0.0)).cast("float"),
        ),
    )


def sigmoid(x: Column) -> Column:
    """Stable for large arguments of either sign."""
    return F.when(x >= 0, 1 / (1 + F.exp(-x))).otherwise(F.exp(x) / (1 + F.exp(x)))


def decode_logits(logits: Column, threshold: float = LABEL_THRESHOLD) -> Column:
    """``ARRAY<STRUCT<label, prob>>`` of the labels whose probability is above the threshold (strict)."""
    scored = F.transform(logits, lambda x, i: F.struct(i.cast("int").alias("label"), sigmoid(x.cast("double")).alias("prob")))
    return F.filter(scored, lambda s: s["prob"] > threshold)


def label_map(hits: Column, labels: Sequence[str]) -> Column:
    """``MAP<label, 0/1>`` over the whole vocabulary, from an array of label ids."""
    flags = let(
        hits,
        lambda h: F.transform(
            F.sequence(F.lit(0), F.lit(len(labels) - 1)),
            lambda i: F.when(F.array_contains(h, i), F.lit(1)).otherwise(F.lit(0)),
        ),
    )
    return F.map_from_arrays(str_array(labels), flags)


def chosen_labels(label_flags: Column) -> Column:
    """The labels of a 0/1 map whose value is 1."""
    return F.map_keys(F.map_filter(label_flags, lambda k, v: v == 1))


def template_length(labels: Sequence[str]) -> int:
    """Characters of the label template: begin and end marks, one mark per label, and two closing marks."""
    return 2 + sum(1 + len(label.strip()) for label in labels) + 2


def content_budget(labels: Sequence[str], max_seq_len: int) -> int:
    """Characters that the label template leaves for the content; an error when it leaves none."""
    return budget_left(template_length(labels), max_seq_len)


def budget_left(length: int, max_seq_len: int) -> int:
    """:func:`content_budget` of a template whose length is known."""
    budget = max_seq_len - length
    if budget <= 0:
        raise ValueError(f"The label template takes {length} of {max_seq_len} places and leaves none for the content.")
    return budget
