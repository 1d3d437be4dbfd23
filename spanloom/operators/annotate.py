"""Turning results back into the annotation-tool layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EXPORT_THRESHOLD
from ..functions.labels import chosen_labels
from .ranks import row_ids
from .spans import select_threshold


def span_annotations(spans: Column, doc: Column) -> Column:
    """Result entries of predicted spans; ids are a hash of document and span, so they repeat between runs."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), F.array(s["entity"]).alias("labels")).alias("value"),
            F.substring(
                F.md5(F.concat_ws(":", doc.cast("string"), s["entity"], s["start"].cast("string"), s["end"].cast("string")).cast("binary")), 1, 10
            ).alias("id"),
            F.lit("label").alias("from_name"),
            F.lit("text").alias("to_name"),
            F.lit("labels").alias("type"),
            F.lit("manual").alias("origin"),
        ),
    )


def export_spans(
    df: DataFrame,
    key: str,
    mail: str,
    text: str = "text",
    spans: str = "spans",
    threshold: float = EXPORT_THRESHOLD,
    task_id: str | None = None,
) -> DataFrame:
    """``id, data, annotations, predictions`` from documents with predicted spans (inclusive threshold).

    Tasks are numbered from 0 in key order; with ``task_id`` an existing number is used and nothing moves.
    """
    if task_id is None:
        df = df.join(row_ids(df.select(key), key, out="__task"), key)
        task_id = "__task"
    task = F.col(task_id).cast("bigint")
    annotation = F.struct(
        task.alias("id"), task.alias("task"), F.lit(0).alias("project"), F.struct(F.lit(mail).alias("email")).alias("completed_by"),
        span_annotations(select_threshold(F.col(spans), threshold, inclusive=True), F.col(key)).alias("result"),
    )
    return df.select(
        task.alias("id"),
        F.struct(F.col(text).alias("jfull_compress")).alias("data"),
        F.array(annotation).alias("annotations"),
        F.array().cast("array<string>").alias("predictions"),
    )


def export_labels(results: DataFrame, key: str = "jid", row_id: str = "id", text: str = "text", flags: str = "pred_labels") -> DataFrame:
    """``id, data, annotations`` from documents with a 0/1 label map."""
    result = F.struct(
        F.struct(chosen_labels(F.col(flags)).alias("choices")).alias("value"),
        F.lit("choices").alias("type"),
        F.lit("medical").alias("from_name"),
        F.lit("text").alias("to_name"),
        F.lit("manual").alias("origin"),
    )
    return results.select(
        F.col(row_id).alias("id"),
        F.struct(F.lit("").alias("text"), F.col(text).alias("jfull_compress"), F.col(key).alias("jid")).alias("data"),
        F.array(F.struct(F.array(result).alias("result"))).alias("annotations"),
    )


def attach_text(results: DataFrame, originals: DataFrame, key: str = "jid", order: str = "id", text: str = "text") -> DataFrame:
    """Add the original text by key; of several originals with one key the last (by ``order``) counts.

    Originals are reduced to one row per key with partial aggregation before the join.
    """
    last = originals.groupBy(key).agg(F.max_by(text, order).alias(text))
    return results.join(last, key)
