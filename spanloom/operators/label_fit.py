"""Linear multi-label classifier on hashed character n-grams: all labels and all strengths in one fit.

A step is one pass over the rows' feature numbers. Every task takes the gradients of the whole weight matrix, one
column for each label and strength, from its rows; the columns are added up in Spark, and only their sums come to the
driver. So the number of passes is that of the steps, whatever the number of labels and strengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import str_array
from ..session import durable
from .metrics import MASKED, multilabel_metrics, predictions

#: ``loss(logits, truth)`` of rows gives each row's loss and the slope at each of its logits.
Loss = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
#: Feature numbers that one step of vectorised work takes at once.
STEP_FEATURES = 1 << 17
#: The logit of a label that is always, or with the other sign never, true: nothing can be learnt of it.
SURE = 20.0


def char_ngrams(text: Column, n: int) -> Column:
    """All n-grams of the whole text, one per position."""
    return F.when(
        F.length(text) >= n, F.regexp_extract_all(F.lower(text), F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))
    ).otherwise(F.array(F.lower(text)))


def ngram_numbers(text: Column, n: int, n_features: int) -> Column:
    """The distinct numbers of a text's n-grams; a NULL text has none."""
    grams = F.when(text.isNull(), str_array([])).otherwise(char_ngrams(text, n))
    return F.array_distinct(F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(n_features)).cast("int")))


def logistic_loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary cross entropy of each label; labels of -100 do not count."""
    known = y != MASKED
    value = np.where(known, np.logaddexp(0, z) - z * y, 0.0).sum(-1)
    return value, np.where(known, 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y, 0.0)


def ranking_loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log(1 + sum of exp of the negatives' logits) + log(1 + sum of exp of minus the positives'); labels of -100 do not count."""

    def side(wanted: int, sign: int) -> tuple[np.ndarray, np.ndarray]:
        terms = np.where(y == wanted, sign * z, -np.inf)
        top = np.maximum(terms.max(-1, initial=0.0), 0.0)[..., None]
        each = np.exp(terms - top)
        total = np.exp(-top) + each.sum(-1, keepdims=True)
        return (top + np.log(total))[..., 0], sign * each / total

    (negative, down), (positive, up) = side(0, 1), side(1, -1)
    return negative + positive, down + up


#: Losses by name, with the largest slope of their gradient.
LOSSES: dict[str, tuple[Loss, float]] = {"logistic": (logistic_loss, 0.25), "ranking": (ranking_loss, 1.0)}


@dataclass
class LabelModel:
    """A weight for each feature and label, and in the last row each label's own."""

    labels: list[str]
    weights: np.ndarray
    ngram: int

    def logits(self, df: DataFrame, text: str = "text", out: str = "logits") -> DataFrame:
        """Add one logit per label. Only the numbers of the n-grams go to Python."""
        n = len(self.weights) - 1
        sent = df.sparkSession.sparkContext.broadcast(self.weights)

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                yield pd.Series(list(_logits(list(rows), sent.value)), index=rows.index)

        return df.withColumn(out, F.pandas_udf(score, returnType="array<double>")(ngram_numbers(F.col(text), self.ngram, n)))


def _logits(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Sums of the rows' weights, over the root of their number, and the last row of the weights."""
    out = np.empty((len(rows), weights.shape[1]))
    for i, numbers in enumerate(rows):
        out[i] = weights[numbers].sum(0) / np.sqrt(max(1, len(numbers))) + weights[-1]
    return out


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(numbers, bounds, truth)`` of so many rows that they hold few numbers, at least one row."""
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        bounds, values = x.offsets.to_numpy(), x.values.to_numpy()
        truth = y.flatten().to_numpy().reshape(batch.num_rows, -1)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + STEP_FEATURES, side="right")) - 1)
            yield values[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], truth[at:to]
            at = to


def _gradients(data: DataFrame, weights: np.ndarray, sets: int, loss: Loss) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows: the slope of each weight, and the loss of each of ``sets`` sets of labels."""
    sent = data.sparkSession.sparkContext.broadcast(weights)
    n, columns = weights.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, slope, value, any_ = sent.value, np.zeros((n, columns)), np.zeros(sets), False
        for numbers, bounds, truth in _steps(batches):
            any_, counts = True, np.diff(bounds)
            row, scale = np.repeat(np.arange(len(counts)), counts), 1 / np.sqrt(np.maximum(counts, 1))
            z = np.zeros((len(counts), columns))
            filled = counts > 0
            if filled.any():
                z[filled] = np.add.reduceat(w[numbers], bounds[:-1][filled], axis=0) * scale[filled, None]
            z += w[-1]
            losses, slopes = loss(z.reshape(len(z), sets, -1), truth[:, None, :])
            value += losses.sum(0)
            slopes = slopes.reshape(len(z), columns)
            slope[-1] += slopes.sum(0)
            for k in range(columns):
                slope[: n - 1, k] += np.bincount(numbers, weights=(slopes[:, k] * scale)[row], minlength=n - 1)
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array([*range(columns), -1], pa.int32()), pa.array([*slope.T.tolist(), value.tolist()], pa.list_(pa.float64()))], ["at", "v"])

    def sum_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            v = batch.column("v")
            bounds, values = v.offsets.to_numpy(), v.values.to_numpy()
            for at, a, b in zip(batch.column("at").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                sums[at] = sums.get(at, 0.0) + values[a:b]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["at", "v"])

    parts = data.mapInArrow(add, "at int, v array<double>").repartition(min(columns + 1, 64), "at").mapInArrow(sum_up, "at int, v array<double>").toArrow()
    found = dict(zip(parts["at"].to_pylist(), (np.asarray(v.values) for v in parts["v"]), strict=True))
    return np.stack([found[k] for k in range(columns)], axis=1), found[-1]


def fit_labels(
    train: DataFrame,
    labels: Sequence[str],
    text: str = "text",
    truth: str = "labels",
    dev: DataFrame | None = None,
    ngram: int = 3,
    n_features: int = 1 << 16,
    strengths: Sequence[float] = (1e-4,),
    max_iter: int = 30,
    metric: str | Callable[[DataFrame], float] = "macro_f1",
    loss: str | tuple[Loss, float] = "logistic",
) -> tuple[LabelModel, DataFrame | None]:
    """Fit all labels under each strength of the penalty at once; keep the strength that is best on ``dev``.

    ``truth`` is a 0/1 vector. ``metric`` is a column of :func:`multilabel_metrics` or a function of the scored frame
    (``labels``, ``logits``, ``predicted``); more is better, and of equal ones the first strength stays. ``loss`` is a
    name or a loss with the largest slope of its gradient. Returns the model and its metrics on ``dev``.
    """
    if not strengths or (dev is None and len(strengths) > 1):
        raise ValueError("Several strengths need rows to choose by; at least one is needed.")
    function, curvature = LOSSES[loss] if isinstance(loss, str) else loss
    n, sets = len(labels), len(strengths)
    data = durable(train.select(ngram_numbers(F.col(text), ngram, n_features).alias("x"), F.col(truth).cast("array<double>").alias("y")).where(F.size("y") == n))
    counts = data.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.get("y", F.lit(i)) == 1).alias(f"p{i}") for i in range(n)], *[F.count_if(F.get("y", F.lit(i)) == 0).alias(f"m{i}") for i in range(n)]).first()
    if not counts["n"]:
        raise ValueError("There are no rows to learn from.")
    penalty = np.repeat(np.asarray(strengths, float), n)
    weights = ahead = np.zeros((n_features + 1, sets * n))
    # Accelerated descent; rows have length 1 and a constant, so the curvature is at most twice that of the loss.
    for step in range(1, max_iter + 1):
        slope = _gradients(data, ahead, sets, function)[0] / counts["n"]
        slope[:-1] += penalty * ahead[:-1]
        moved = ahead - slope / (2 * curvature + penalty)
        ahead, weights = moved + (step - 1) / (step + 2) * (moved - weights), moved
    for i in range(n):
        if not counts[f"p{i}"] or not counts[f"m{i}"]:
            weights[:, i::n] = 0.0
            weights[-1, i::n] = SURE if counts[f"p{i}"] else -SURE
    models = [LabelModel(list(labels), weights[:, k * n : (k + 1) * n].copy(), ngram) for k in range(sets)]
    if dev is None:
        return models[0], None
    # One pass scores all strengths.
    together = LabelModel([], weights, ngram).logits(dev.select(F.col(text).alias("text"), F.col(truth).alias("labels")), out="all")
    scored = durable(together.drop("text"))
    best: tuple[float, LabelModel, DataFrame] | None = None
    for k, model in enumerate(models):
        own = scored.select("labels", F.slice("all", k * n + 1, n).alias("logits")).withColumn("predicted", predictions(F.col("logits")))
        report = multilabel_metrics(own, n)
        row = report.first()
        reached = row[metric] if isinstance(metric, str) else metric(own)
        if best is None or reached > best[0]:
            best = (reached, model, df_of(report, row))
    return best[1], best[2]


def df_of(like: DataFrame, row) -> DataFrame:
    return like.sparkSession.createDataFrame([row], like.schema)
