"""Span models over windows of long documents: batches of windows in, spans of whole documents out.

A document stays one row. Its text is cut into windows of a fixed length that overlap by more than the longest span, so
every span lies within some window and not at one of its cuts. The model sees batches of windows of many documents and
prompts; its start and end probabilities become spans, their offsets move back to the document, what touches a cut is
left to the window beside it, and a span that two windows found counts once, with the higher probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SPANS

#: Text bytes whose spans are held at once; a longer text is taken alone.
SLICE_BYTES = 1 << 20
#: ``model(prompts, contents)`` gives for each window its start and end probabilities, one number per character.
SpanModel = Callable[[list[str], list[str]], Iterable[tuple[np.ndarray, np.ndarray]]]


def window_starts(length: int, window: int, overlap: int) -> list[int]:
    """Where the windows of a text of ``length`` characters start; the last one ends with the text."""
    if length <= window:
        return [0]
    starts = list(range(0, length - window, window - overlap))
    return [*starts, length - window]


def decoded_spans(start: np.ndarray, end: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, probability)`` of the spans of one window; ends are behind the last character.

    A start belongs to the nearest end at or behind it; of several starts of one end the last counts. The
    probability is the product of both.
    """
    starts, ends = np.flatnonzero(start > threshold), np.flatnonzero(end > threshold)
    at = np.searchsorted(ends, starts)
    starts, at = starts[at < len(ends)], at[at < len(ends)]
    last = np.ones(len(at), bool)
    last[:-1] = at[1:] != at[:-1]
    starts, ends = starts[last], ends[at[last]]
    return starts, ends + 1, start[starts].astype(float) * end[ends].astype(float)


def _document_spans(texts: list[str | None], prompts: Sequence[str], model: SpanModel, window: int, overlap: int, threshold: float, batch: int) -> list[list[dict]]:
    """The spans of each text, by prompt and start."""
    found: list[dict[tuple[int, int, int], float]] = [{} for _ in texts]
    waiting: list[tuple[int, int, int, int]] = []  # text, prompt, window start, window end

    def score() -> None:
        answers = list(model([prompts[p] for _, p, _, _ in waiting], [texts[d][a:b] for d, _, a, b in waiting]))
        if len(answers) != len(waiting):
            raise ValueError(f"The model gave {len(answers)} answers for {len(waiting)} windows.")
        for (d, p, a, b), (start, end) in zip(waiting, answers, strict=True):
            if len(start) != b - a or len(end) != b - a:
                raise ValueError("The model must give one probability per character.")
            for s, e, q in zip(*(x.tolist() for x in decoded_spans(np.asarray(start), np.asarray(end), threshold)), strict=True):
                cut = (s == 0 and a > 0) or (e == b - a and b < len(texts[d]))
                if not cut and e - s < overlap:
                    key = (p, a + s, a + e)
                    found[d][key] = max(q, found[d].get(key, 0.0))
        waiting.clear()

    for d, text in enumerate(texts):
        for p in range(len(prompts)):
            for a in window_starts(len(text or ""), window, overlap) if text else ():
                waiting.append((d, p, a, min(len(text), a + window)))
                if len(waiting) == batch:
                    score()
    if waiting:
        score()
    out = []
    for text, spans in zip(texts, found, strict=True):
        rows, number = [], [0] * len(prompts)
        for (p, a, b), q in sorted(spans.items()):
            rows.append({"entity": prompts[p], "ord": number[p], "start": a, "end": b, "text": text[a:b], "probability": q})
            number[p] += 1
        out.append(rows)
    return out


def _slices(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no slice holds more than ``SLICE_BYTES`` of text, except one longer row alone."""
    for rows in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(rows.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < rows.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield rows.slice(at, to - at)
            at = to


def model_spans(
    df: DataFrame, make_model: Callable[[], SpanModel], prompts: Sequence[str], window: int = 512, overlap: int = 64, threshold: float = 0.5, batch: int = 64,
    text: str = "text", out: str = "spans",
) -> DataFrame:
    """Add the spans that a model finds for each prompt. ``make_model()`` runs once per task.

    Spans of ``overlap`` characters or more are not looked for, as a cut may go through them. A NULL or empty text has none.
    """
    if not 0 < overlap < window:
        raise ValueError("overlap is positive and less than window")
    spans = df.sparkSession.range(0).select(F.lit(None).cast(SPANS).alias("x")).schema["x"].dataType
    kept = df.drop(out)
    schema, names = T.StructType([*kept.schema, T.StructField(out, spans)]), kept.columns
    prompts = list(prompts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, kind = make_model(), None
        for rows in _slices(batches, text):
            kind = kind or pa.list_(pa.struct([("entity", pa.string()), ("ord", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("probability", pa.float64())]))
            values = _document_spans(rows.column(text).to_pylist(), prompts, model, window, overlap, threshold, batch)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(values, kind)], [*names, out])

    return kept.mapInArrow(run, schema)
