"""The label fit against plain gradients, and its hooks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import label_fit, scoring


def labelled(spark, n=80):
    rows = [(i, ("apple pie " if i % 2 else "green tea ") * 3 + str(i), [i % 2, 1 - i % 2, 0]) for i in range(n)]
    return spark.createDataFrame(rows, "id int, text string, labels array<int>").repartition(3)


NAMES = ["pie", "tea", "never"]


def test_fit_labels(spark):
    df = labelled(spark)
    for loss in ("logistic", "ranking"):
        model, report = label_fit.fit_labels(df.where("id < 60"), NAMES, dev=df.where("id >= 60"), n_features=1 << 10, strengths=(1e-3, 10.0), loss=loss)
        row = report.first()
        assert row.micro_f1 == 1.0 and row.accuracy == 1.0
        scored = scoring.decode_labels(scoring.score_labels(df, NAMES, model=model), NAMES)
        assert scored.where("pred_labels['pie'] = labels[0]").count() == 80
    assert label_fit.fit_labels(df, NAMES, n_features=1 << 8)[1] is None
    with pytest.raises(ValueError, match="Several strengths"):
        label_fit.fit_labels(df, NAMES, strengths=(1.0, 2.0))
    with pytest.raises(ValueError, match="no rows"):
        label_fit.fit_labels(df.limit(0), NAMES)


def test_metric_and_loss_can_be_replaced(spark):
    df, seen = labelled(spark), []

    def latest(scored):
        seen.append(sorted(scored.columns))
        return float(len(seen))

    def squares(z, y):
        return ((z - (2 * y - 1)) ** 2).sum(-1) / 2, z - (2 * y - 1)

    model, _ = label_fit.fit_labels(df, NAMES, dev=df, n_features=1 << 8, strengths=(1e-3, 100.0), metric=latest, loss=(squares, 1.0))
    assert seen == [["labels", "logits", "predicted"]] * 2 and np.abs(model.weights[:-1]).max() < 0.1


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    z, y = draw.normal(size=(6, 5)) * 3, draw.integers(0, 2, (6, 5)).astype(float)
    y[0, 0], y[1] = label_fit.MASKED, 0
    for loss, _ in label_fit.LOSSES.values():
        value, slope = loss(z, y)
        for k in range(5):
            step = np.zeros(5)
            step[k] = 1e-6
            assert np.allclose((loss(z + step, y)[0] - loss(z - step, y)[0]) / 2e-6, slope[:, k], atol=1e-5)
        assert value.shape == (6,) and slope[0, 0] == 0


def test_passes_do_not_grow_with_labels_and_strengths(spark, monkeypatch):
    calls = []
    own = label_fit._gradients
    monkeypatch.setattr(label_fit, "_gradients", lambda data, w, sets, loss: calls.append(w.shape[1]) or own(data, w, sets, loss))
    df = labelled(spark, 20)
    label_fit.fit_labels(df, NAMES, dev=df, n_features=64, strengths=(0.1, 1.0, 10.0), max_iter=4)
    assert calls == [9] * 4


def test_summed_gradients(spark, monkeypatch):
    monkeypatch.setattr(label_fit, "STEP_FEATURES", 5)
    draw = np.random.default_rng(1)
    rows = [(sorted({int(i) for i in draw.integers(0, 20, draw.integers(0, 9))}), draw.integers(0, 2, 2).astype(float).tolist()) for _ in range(40)]
    weights = draw.normal(size=(21, 4))
    slope, value = label_fit._gradients(spark.createDataFrame(rows, "x array<int>, y array<double>").repartition(3), weights, 2, label_fit.logistic_loss)
    x = np.zeros((40, 21))
    x[:, -1] = 1
    for r, (numbers, _) in enumerate(rows):
        x[r, numbers] = 1 / np.sqrt(max(1, len(numbers)))
    y = np.array([r[1] for r in rows])
    losses, slopes = label_fit.logistic_loss((x @ weights).reshape(40, 2, 2), y[:, None, :])
    assert np.allclose(slope, x.T @ slopes.reshape(40, 4)) and np.allclose(value, losses.sum(0))


def test_ngrams_cover_the_whole_text(spark):
    df = spark.createDataFrame([("ABcd\nE",), ("ab",), (None,)], "t string")
    got = df.select(label_fit.char_ngrams(F.col("t"), 3).alias("g"), F.size(label_fit.ngram_numbers(F.col("t"), 3, 1 << 20)).alias("n")).collect()
    assert [r.g for r in got[:2]] == [["abc", "bcd", "cd\n", "d\ne"], ["ab"]] and [r.n for r in got] == [4, 1, 0]
