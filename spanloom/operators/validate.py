"""Checks that turn into reject tables, or into errors in strict mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import slice_of
from ..functions.labels import unknown_labels

REASON = "reject_reason"


def stop_on(df: DataFrame, strict: bool) -> DataFrame:
    """In strict mode fail the job on the first row with a reason."""
    if not strict:
        return df
    reason = F.col(REASON)
    # A filter, because an unused column would be pruned together with its check.
    return df.where(F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean")))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())


def only_span_annotations(types: Column) -> Column:
    """Reason when an annotation is not a span label."""
    return F.when(F.exists(types, lambda t: t != "labels"), F.lit("only span labels are accepted"))


def known_labels(names: Column, labels: Sequence[str]) -> Column:
    """Reason when a label is not in the vocabulary."""
    unknown = unknown_labels(names, labels)
    return F.when(F.size(unknown) > 0, F.concat(F.lit("label not in vocabulary: "), F.array_join(F.array_sort(unknown), ",")))


def prompt_example_reason(content: Column, result_list: Column, prompt: Column, prompts: Sequence[str] | None = None) -> Column:
    """Reason when a prompt example lacks a key, has an unknown prompt or a span that is not its slice."""
    missing = F.when(content.isNull() | result_list.isNull() | prompt.isNull(), F.lit("missing key"))
    unknown = F.when(~prompt.isin(list(prompts)), F.lit("unknown prompt")) if prompts is not None else F.lit(None).cast("string")
    wrong = F.when(
        F.exists(result_list, lambda s: slice_of(content, s["start"], s["end"]) != s["text"]), F.lit("slice differs from span text")
    )
    return F.coalesce(missing, unknown, wrong)


def validate_prompt_examples(df: DataFrame, prompts: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """All rows are checked."""
    reason = prompt_example_reason(F.col("content"), F.col("result_list"), F.col("prompt"), prompts)
    return stop_on(df.withColumn(REASON, reason), strict)


LABEL_EXAMPLE_KEYS = ["text_a", "text_b", "question", "choices", "labels"]


def validate_label_examples(df: DataFrame) -> None:
    """The five keys of a label example must be present."""
    missing = [k for k in LABEL_EXAMPLE_KEYS if k not in df.columns]
    if missing:
        raise ValueError(f"Missing keys: {missing}.")


def span_reason(spans: Column, capacity: Column) -> Column:
    """Reason when spans cannot be cut into chunks: reversed, or too long."""
    reversed_span = F.exists(spans, lambda s: s["start"] > s["end"])
    too_long = F.exists(spans, lambda s: s["end"] - s["start"] > capacity)
    return (
        F.when(capacity <= 0, F.lit("max_seq_len is too small"))
        .when(reversed_span, F.lit("start after end"))
        .when(too_long, F.lit("span longer than a chunk"))
    )


