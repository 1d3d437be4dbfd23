"""Spans of a model over windows against its spans over whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from spanloom.operators.windows import SLICE_BYTES, _document_spans, _slices, decoded_spans, model_spans, window_starts
from spanloom.plans.queries import character_model


def test_windows_cover_a_text():
    for length in range(0, 60):
        starts = window_starts(length, 12, 5)
        assert starts[0] == 0 and max(starts[-1], 0) + 12 >= length and all(0 < b - a <= 12 - 5 for a, b in zip(starts, starts[1:], strict=False))
        assert starts[-1] + 12 <= max(length, 12)


def test_decoding():
    start, end = np.array([0.9, 0.8, 0, 0.6, 0, 0.9]), np.array([0, 0.5, 0.7, 0.9, 0, 0])
    s, e, p = decoded_spans(start, end, 0.4)
    assert list(zip(s.tolist(), e.tolist(), np.round(p, 6).tolist(), strict=True)) == [(1, 2, 0.4), (3, 4, 0.54)]
    assert [len(x) for x in decoded_spans(np.zeros(0), np.zeros(0), 0.5)] == [0, 0, 0]


def test_as_over_whole_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("12345AB甲𠀀 x") if rng.random() < 0.8 else rng.choice("12") * rng.randrange(1, 30) for _ in range(rng.randrange(0, 400))) for _ in range(60)]
    rows = [(i, t, "other") for i, t in enumerate([*texts, None, ""])]
    df = spark.createDataFrame(rows, "id int, text string, kept string").repartition(3)
    prompts = ["digits", "capitals"]
    whole = _document_spans([t for _, t, _ in rows], prompts, character_model(), 10**6, 20, 0.5, 7)
    for window, batch in ((50, 1), (64, 5), (41, 1000)):
        got = {r["id"]: [s.asDict() for s in r["spans"]] for r in model_spans(df, character_model, prompts, window, 20, batch=batch).collect()}
        assert got == dict(enumerate(whole))
    assert max(s["end"] - s["start"] for spans in whole for s in spans) == 19 and whole[-1] == whole[-2] == []
    assert model_spans(df, character_model, prompts).columns == ["id", "text", "kept", "spans"]


def test_the_higher_probability_counts():
    def model(prompts, contents):
        for c in contents:  # the further into its window, the surer
            at = np.array([ch == "x" for ch in c]) * np.linspace(0.6, 1.0, len(c))
            yield at, at

    text = "a" * 12 + "x" + "a" * 12
    (span,) = _document_spans([text], ["p"], model, 15, 8, 0.5, 10)[0]
    assert (span["start"], span["end"], span["text"]) == (12, 13, "x") and span["probability"] == pytest.approx((0.6 + 0.4 * 12 / 14) ** 2)


def test_wrong_answers(spark):
    df = spark.createDataFrame([("abc",)], "text string")
    with pytest.raises(ValueError, match="overlap"):
        model_spans(df, character_model, ["digits"], 10, 10)
    with pytest.raises(ValueError, match="answers for"):
        _document_spans(["abc"], ["p"], lambda prompts, contents: [], 10, 5, 0.5, 4)
    with pytest.raises(ValueError, match="per character"):
        _document_spans(["abc"], ["p"], lambda prompts, contents: [(np.zeros(2), np.zeros(3))], 10, 5, 0.5, 4)


def test_slices_hold_bounded_text():
    """A batch of much text is taken in slices, a longer text alone; a NULL takes no room."""
    texts = ["a" * (SLICE_BYTES // 3), None, "b" * (SLICE_BYTES // 2), "c" * (SLICE_BYTES // 2), "d" * (2 * SLICE_BYTES), "", "e"]
    cut = list(_slices([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])] * 2, "text"))
    assert [r.num_rows for r in cut] == [3, 1, 1, 2] * 2
    assert [t for r in cut for t in r.column("text").to_pylist()] == texts * 2
