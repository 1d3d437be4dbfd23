"""Model hooks: a scorer is any function over batches; rules and linear models are the built-in ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_map
from ..functions.rules import Rule
from ..schemas import SPANS
from .label_fit import LabelModel
from .metrics import multilabel_metrics
from .spans import extract_spans, select_spans

BatchScorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def score_spans(df: DataFrame, make_scorer: Callable[[], Callable[[str], list[dict]]], text: str = "text", out: str = "spans") -> DataFrame:
    """Add spans from a user model: ``make_scorer()`` runs once per task and returns text → list of spans.

    Each span is a dict of entity, start, end, text, probability.
    """
    span_schema = SPANS

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for batch in texts:
            yield batch.map(lambda t: [_numbered(s, i) for i, s in enumerate(scorer(t))] if t is not None else [])

    udf = F.pandas_udf(run, returnType=_parse(df, span_schema))
    return df.withColumn(out, udf(F.col(text)))


def _parse(df: DataFrame, ddl: str):
    return df.sparkSession.range(0).select(F.lit(None).cast(ddl).alias("x")).schema["x"].dataType


def _numbered(span: dict, i: int) -> dict:
    return {
        "entity": span["entity"], "ord": span.get("ord", i), "start": int(span["start"]), "end": int(span["end"]),
        "text": span["text"], "probability": float(span["probability"]),
    }


def infer_spans(
    df: DataFrame,
    rules: Mapping[str, Rule] | None = None,
    make_scorer: Callable | None = None,
    preprocess: Callable[[Column], Column] | None = None,
    postprocess: Callable[[DataFrame], DataFrame] | None = None,
    strategy: str | Callable = "all",
    threshold: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """Preprocess the text, find spans by rules or by a user model, select them, postprocess.

    ``preprocess`` maps the text column, ``postprocess`` maps the frame; both are ordinary Spark code.
    """
    if preprocess is not None:
        df = df.withColumn(text, preprocess(F.col(text)))
    df = score_spans(df, make_scorer, text) if make_scorer is not None else extract_spans(df, rules or {}, text)
    df = select_spans(df, strategy, threshold)
    return postprocess(df) if postprocess is not None else df


# --- multi-label classifier ----------------------------------------------------------------------


def evaluate_labels(model: LabelModel, df: DataFrame, text: str = "text", truth: str = "labels") -> DataFrame:
    from .metrics import predictions

    scored = model.logits(df, text).withColumn("predicted", predictions(F.col("logits")))
    return multilabel_metrics(scored, len(model.labels), truth)


def score_labels(
    df: DataFrame,
    labels: Sequence[str],
    model: LabelModel | None = None,
    make_scorer: Callable[[], Callable[[list[str]], list[list[float]]]] | None = None,
    text: str = "text",
    out: str = "logits",
) -> DataFrame:
    """Add one logit per label, from a fitted model or from a user scorer that maps texts to logits in batches."""
    if model is not None:
        return model.logits(df, text, out)
    if make_scorer is None:
        raise ValueError("Give a fitted model or a scorer.")
    n = len(labels)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for batch in texts:
            scores = scorer(batch.tolist())
            if any(len(s) != n for s in scores):
                raise ValueError(f"The scorer must return {n} logits per text.")
            yield pd.Series(scores, index=batch.index)

    return df.withColumn(out, F.pandas_udf(run, returnType="array<double>")(F.col(text)))


def decode_labels(df: DataFrame, labels: Sequence[str], threshold: float = 0.5, logits: str = "logits", out: str = "pred_labels") -> DataFrame:
    """Replace logits by a 0/1 map over the vocabulary."""
    from ..functions.labels import decode_logits

    hits = F.transform(decode_logits(F.col(logits), threshold), lambda s: s["label"])
    return df.withColumn(out, label_map(hits, labels)).drop(logits)
