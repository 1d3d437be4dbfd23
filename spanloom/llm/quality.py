"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. The weights maximise the likelihood that the better one of
a pair wins, ``1 / (1 + exp(-(s_i - s_j)))``: a logistic loss on differences of features. The cut is the quantile of
the strengths at which the share of labelled documents below it is that of the poor ones, and scores are scaled so
that the cut lies at ``threshold``.

Learning takes every labelled row and all pairs of a good and a poor one: a row's part in the slope depends on its own
strength and the distribution of the others' alone, so that each step reads the rows twice and never a pair. Knots and
cut are exact ranks over all rows. Features meet labels by id; texts stay where they are read. Every row is scored, over
its whole text.

Cases: a NULL or empty text has all features 0 but one that says so; ties have equal scores; repeated rows are scored
each; a NULL id is scored and never a label; without labels of both kinds all scores are ``threshold``, so nothing is
rejected; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, id_and_text, lists, shuffle_parts, slices, small_batches, written
from .vectors import matrix, row_steps, vector_sums
from .words import Words

#: Newton steps at most, and the gain in loss that is not worth another.
STEPS, ENOUGH = 30, 1e-6
#: Strengths are tabled from ``-FAR`` to ``FAR`` in ``BINS`` bins a unit, and from ``-NEAR`` to ``NEAR`` in ``COARSE``.
FAR, BINS, NEAR, COARSE = 64, 32, 16, 4
_MARKS = b"!#$%&'()*+,-./:;<=>?@[]_|~\""


def features(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text: what its characters, words and lines are like."""
    words = Words(column, lower=True)
    data, bounds, n = words.data, words.bounds, len(words.count)
    size = np.diff(bounds).astype(float)
    full = np.maximum(size, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / full

    kinds = np.zeros(256, np.uint8)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[128:] = 1, 2, 3, 4
    for i, m in enumerate(_MARKS):
        kinds[m] = 5 + i
    kind = kinds[data]
    columns = [share(kind == k) for k in range(1, 5 + len(_MARKS))] + [share(data == 10), share(data == 32)]
    columns.append(share(kind >= 5))

    count = words.count.astype(float)
    some = np.maximum(count, 1)
    length = (words.end - words.start).astype(float)
    mean = np.bincount(words.doc, weights=length, minlength=n) / some
    columns += [np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(np.bincount(words.doc, weights=length**2, minlength=n) / some - mean**2, 0))]
    columns += [np.bincount(words.doc, weights=length <= 3, minlength=n) / some, np.bincount(words.doc, weights=length >= 12, minlength=n) / some]
    # Repetition: distinct words, the most frequent word, and words equal to the one before.
    order = np.lexsort((words.code, words.doc))
    doc, code = words.doc[order], words.code[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    begins = np.flatnonzero(new)
    often = np.zeros(n)
    np.maximum.at(often, doc[begins], np.diff(np.append(begins, len(doc))))
    same = np.zeros(len(words), bool)
    same[1:] = (words.code[1:] == words.code[:-1]) & (words.doc[1:] == words.doc[:-1])
    columns += [np.bincount(doc[begins], minlength=n) / some, often / some, np.bincount(words.doc, weights=same, minlength=n) / some]
    # Sentence marks after a word, and capitals before one.
    ended = np.isin(data[words.end - 1], np.frombuffer(b".!?", np.uint8)) if len(words) else np.zeros(0, bool)
    capital = kind[words.start] == 1 if len(words) else np.zeros(0, bool)
    marked = kind[words.end - 1] >= 5 if len(words) else np.zeros(0, bool)
    columns += [np.bincount(words.doc, weights=x, minlength=n) / some for x in (ended, capital, marked)]
    # Lines: how many, how long, how many repeat one of the same text.
    breaks = np.zeros(len(data) + 1, bool)
    breaks[bounds[:-1]] = True
    breaks[1:] |= data == 10
    start = np.flatnonzero(breaks[:-1])
    if len(start):
        end = np.append(start[1:], len(data))
        of = np.searchsorted(bounds, start, side="right") - 1
        line = words.range_codes(start, np.maximum(start, end - (data[end - 1] == 10)))
        order = np.lexsort((line, of))
        fresh = np.ones(len(of), bool)
        fresh[1:] = (of[order][1:] != of[order][:-1]) | (line[order][1:] != line[order][:-1])
        lines = np.maximum(np.bincount(of, minlength=n), 1)
        columns += [np.log1p(lines), 1 - np.bincount(of[order], weights=fresh, minlength=n) / lines, np.log1p(size / lines)]
    else:
        columns += [np.zeros(n)] * 3
    plain = np.stack(columns, 1)
    plain[size == 0] = 0
    # In single precision, as they are stored to learn from.
    return np.concatenate([plain, (count == 0).astype(float)[:, None]], 1).astype(np.float32).astype(float)


@dataclass
class Ranking:
    """What scoring needs: the scale of the features, knots that bend them, weights, and the cut."""

    middle: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    weights: np.ndarray
    cut: float
    width: float
    threshold: float

    def bent(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.scale, -8, 8)
        return np.concatenate([z, *[np.maximum(x - k, 0) / self.scale for k in self.knots]], 1).clip(-8, 8)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.bent(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip((self.strength(x) - self.cut) / self.width + at, -30, 30)))


def _sums(rows: DataFrame, step: Callable[[np.ndarray, np.ndarray], Iterable[tuple[int, np.ndarray]]], parts: int = 1) -> dict[int, np.ndarray]:
    """The vectors that ``step(x, label)`` gives by number for each batch of ``rows (label, x)``, all of one length, added up over all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in row_steps(batches, 256):
            for at, v in step(matrix(batch.column("x")).astype(float), batch.column("label").to_numpy(zero_copy_only=False)):
                sums[at] = sums[at] + v if at in sums else v
        if sums:
            vectors = lists(np.concatenate(list(sums.values())), [len(v) for v in sums.values()], pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), vectors], ["at", "v"])

    partials = rows.select("label", "x").mapInArrow(run, "at int, v array<double>")
    return {r["at"]: np.array(r["v"]) for r in vector_sums(partials, parts).collect()}


def _ranked(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray], width: int, ranks: list[int]) -> np.ndarray:
    """For each rank (from 0) and column of ``values(x)`` the number of that rank among all rows, in single precision.

    Ordered as whole numbers of 32 bits, a number is found byte by byte from the counts of the next byte.
    """
    found = np.zeros((len(ranks), width), np.int64)
    left = np.repeat(np.array(ranks)[:, None], width, axis=1)
    for shift in (24, 16, 8, 0):

        def count(x: np.ndarray, _: np.ndarray, shift: int = shift, found: np.ndarray = found) -> Iterator[tuple[int, np.ndarray]]:
            bits = values(x).astype(np.float32).view(np.uint32)
            keys = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.int64)
            for (r, c), known in np.ndenumerate(found):
                same = keys[keys[:, c] >> (shift + 8) == known, c]
                yield r * width + c, np.bincount((same >> shift) & 255, minlength=256).astype(float)

        counts = _sums(rows, count)
        found = found.copy()
        for r, c in np.ndindex(*found.shape):
            upto = np.cumsum(counts[r * width + c])
            byte = int(np.searchsorted(upto, left[r, c], side="right"))
            left[r, c] -= int(upto[byte - 1]) if byte else 0
            found[r, c] = found[r, c] << 8 | byte
    keys = found.astype(np.uint32)
    return np.where(keys >> 31, keys & np.uint32((1 << 31) - 1), ~keys).astype(np.uint32).view(np.float32).astype(float)


def _spread(rows: DataFrame, model: Ranking) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """For the poor and for the good rows: the mean strength in each bin that has rows, and their number."""

    def step(x: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        at = model.strength(x)
        cell = np.clip(np.floor((at + FAR) * BINS), 0, 2 * FAR * BINS - 1).astype(np.int64)
        for kind in (0, 1):
            mine = label == kind
            yield kind, np.concatenate([np.bincount(cell[mine], weights=w, minlength=2 * FAR * BINS) for w in (np.ones(mine.sum()), at[mine])])

    sums = _sums(rows, step, 2)
    return tuple((total[count > 0] / count[count > 0], count[count > 0]) for count, total in (np.split(sums[kind], 2) for kind in (0, 1)))


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _steepness(rows: DataFrame, model: Ranking, spread) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the mean loss of all pairs of a good and a poor row, by the weights.

    A row's pull depends on its strength alone: the sum over all rows of the other kind, read from a table over the
    strengths. The curvature takes the strengths by coarse bins, and products of a good and a poor row by their sums.
    """
    pairs, width = spread[0][1].sum() * spread[1][1].sum(), len(model.weights)
    grid = np.linspace(-FAR, FAR, 2 * FAR * BINS + 1)
    cells = 2 * NEAR * COARSE

    def cell_of(at: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((at + NEAR) * COARSE), 0, cells - 1).astype(np.int64)

    chance = _chance(np.subtract.outer(np.arange(cells), np.arange(cells)) / COARSE)
    near = chance * (1 - chance) / pairs
    pull, bend = [], []  # by kind: of a strength, and of a coarse bin
    for kind, sign in ((0, 1), (1, -1)):
        other, count = spread[1 - kind]
        pull.append(sign * (_chance(sign * (grid[:, None] - other)) @ count) / pairs)
        bend.append(near @ np.bincount(cell_of(other), weights=count, minlength=cells))

    def step(x: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        bent = model.bent(x)
        at = bent @ model.weights
        for kind in (0, 1):
            b, s = bent[label == kind], at[label == kind]
            cell = cell_of(s)
            yield 0, np.interp(s, grid, pull[kind]) @ b
            for i, v in enumerate((b * bend[kind][cell][:, None]).T @ b):
                yield 1 + i, v
            for c in np.unique(cell).tolist():
                yield 1 + width + kind * cells + c, b[cell == c].sum(0)

    sums = _sums(rows, step, min(width, shuffle_parts(rows.sparkSession)))
    curve = np.stack([sums[1 + i] for i in range(width)])
    poor, good = (np.stack([sums.get(1 + width + kind * cells + c, np.zeros(width)) for c in range(cells)]) for kind in (0, 1))
    cross = poor.T @ near @ good
    return sums[0], curve - cross - cross.T


def _loss(spread, weights: np.ndarray, penalty: float) -> float:
    (poor, poors), (good, goods) = spread
    return float(goods @ np.logaddexp(0, poor - good[:, None]) @ poors / (goods.sum() * poors.sum()) + penalty / 2 * weights @ weights)


def fit(rows: DataFrame, threshold: float, penalty: float = 1e-3) -> Ranking:
    """Learn from all ``rows (label, x)``: Newton steps on the mean loss of all pairs of a good and a poor row."""
    sums = _sums(rows, lambda x, y: [(1, x.sum(0)), *[(2 + kind, np.full(x.shape[1], float((y == kind).sum()))) for kind in (0, 1)]])
    if not sums or not sums[2][0] or not sums[3][0]:
        return Ranking(np.zeros(0), np.ones(0), np.zeros((0, 0)), np.zeros(0), 0.0, 1.0, threshold)
    poors, n = int(sums[2][0]), int(sums[2][0] + sums[3][0])
    # Rounded, since sums of fractions depend on the order of the tasks.
    middle = (sums[1] / n).astype(np.float32).astype(float)
    scale = np.sqrt(_sums(rows, lambda x, _: [(0, ((x - middle) ** 2).sum(0))])[0] / n).astype(np.float32).astype(float)
    knots = _ranked(rows, lambda x: x, len(middle), [int(q * (n - 1)) for q in (0.05, 0.5, 0.95)])
    model = Ranking(middle, np.where(scale > 1e-6, scale, 1.0), knots, np.zeros(len(middle) * (1 + len(knots))), 0.0, 1.0, threshold)
    spread = _spread(rows, model)
    loss = _loss(spread, model.weights, penalty)
    for _ in range(STEPS):
        slope, curve = _steepness(rows, model, spread)
        slope = slope + penalty * model.weights
        values, vectors = np.linalg.eigh((curve + curve.T) / 2)
        step = vectors @ ((vectors.T @ slope) / (np.maximum(values, 0) + penalty))
        if step @ slope < ENOUGH:
            break
        for half in range(10):
            trial = replace(model, weights=np.round(model.weights - step / 2**half, 9))
            there = _spread(rows, trial)
            if (after := _loss(there, trial.weights, penalty)) < loss:
                break
        else:
            break
        model, spread, loss = trial, there, after
    # The share of rows below the cut is that of the poor ones.
    at, count = (np.concatenate(c) for c in zip(*spread, strict=True))
    around = _ranked(rows, lambda x: model.strength(x)[:, None], 1, [poors - 1, poors])
    width = np.sqrt(max(np.average((at - np.average(at, weights=count)) ** 2, weights=count), 0.0)) / 4
    return replace(model, cut=float(around.mean()), width=float(max(width, 1e-6)))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column) -> DataFrame:
    """``label, x`` of every labelled row of ``docs`` for which ``may_learn``, over ``doc_id``, holds, written.

    The features are taken where the texts are read and meet the labels by id; no text moves.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter(may_learn & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.min("label").alias("label"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=STEP_BYTES):
            x = features(part["text"])
            yield pa.RecordBatch.from_arrays([part["doc_id"], lists(x.ravel(), np.full(*x.shape), pa.float32())], ["doc_id", "x"])

    read = docs.filter(may_learn & F.col("doc_id").isNotNull()).select("doc_id", "text")
    with small_batches(docs.sparkSession):
        return written(read.mapInArrow(compute, "doc_id bigint, x array<float>").join(known, "doc_id").select("label", "x"))


def scored(docs: DataFrame, model: Ranking) -> DataFrame:
    """``doc_id, score`` of each row, with every further column of ``docs``; ``docs`` has ``doc_id`` and ``text``."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=STEP_BYTES):
            model = sent.value
            x = features(part["text"])
            values = model.score(x) if x.shape[1] == len(model.middle) else np.full(part.num_rows, model.threshold)
            yield part.append_column("score", pa.array(values, pa.float64()))

    return docs.mapInArrow(score, ", ".join([*kept, "score double"]))


def quality_model(docs: DataFrame, labels: DataFrame, may_learn: Column, threshold: float = 0.3, label: str = "quality") -> Ranking:
    return fit(labelled_features(id_and_text(docs), labels, label, may_learn), threshold)
