"""Two-stage classification: shrink each document to its relevant windows, then score the labels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LABEL_THRESHOLD, SHRINK_THRESHOLD
from ..functions.labels import content_budget
from ..functions.rules import Rule
from ..operators.merge import expand_labels, merge_results
from ..operators.scoring import LabelModel, decode_labels, score_labels, score_spans
from ..operators.shrink import shrink_documents
from ..schemas import SPANS


def classify_documents(
    documents: DataFrame,
    labels: Sequence[str],
    rules: Mapping[str, Rule],
    max_seq_len: int = 768,
    model: LabelModel | None = None,
    make_label_scorer: Callable | None = None,
    make_span_scorer: Callable | None = None,
    text: str = "text",
    span_threshold: float = SHRINK_THRESHOLD,
    label_threshold: float = LABEL_THRESHOLD,
    dynamic: bool = True,
    compat: bool = False,
) -> DataFrame:
    """The documents with their shortened text and a 0/1 map ``pred_labels``. Everything is local to a row."""
    if make_span_scorer is not None:
        found = score_spans(documents, make_span_scorer, text)
    else:
        found = documents.withColumn("spans", F.array().cast(SPANS))
    short = shrink_documents(found, content_budget(labels, max_seq_len), rules, text, "spans", span_threshold, dynamic, compat)
    scored = score_labels(short.drop("spans"), labels, model, make_label_scorer, text)
    return decode_labels(scored, labels, label_threshold)


def merge_tables(flat: DataFrame, classified: DataFrame, labels: Sequence[str], validate: bool = True) -> DataFrame:
    """Join the flat extraction table with the classified documents on all columns they share."""
    return merge_results(flat, expand_labels(classified, labels), validate)
