"""Hard negatives of anchors, by a secondary sort of scored pairs.

Anchors meet all rows in blocks: an equi join on the cell of a grid, rows dealt over its lines and anchors over its
columns, both of bounded size. A cell scores its anchors against its rows by matrix multiplication and hands over
only pairs that may be in the answer: the first rows of the anchor's label, later the first rows within each window
of an anchor's positives. These pairs are shuffled by anchor and sorted within their partition by (anchor,
descending score, id). An iterator walks over them: a positive opens its window, a negative goes to every window
that is open for its score, and nothing of an anchor is kept but its windows.

Cases: rows with a NULL id or label, or a vector that is NULL or holds a NULL or a number that isn't finite, take no
part; of rows with one id the one with the smallest label and vector does; shorter vectors count as filled up with
zeros, components saturate at 2^27, so that scores fit a long; equal scores come by smaller id; a positive without a
positive score has no window, but for a score of zero, whose window is zero; an empty table, or one without anchors,
gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, shuffle_parts, written
from .vectors import matrix, whole_vectors

#: Rows and anchors of one cell of the grid.
CELL_ROWS, CELL_ANCHORS = 16_384, 1_024
#: Scores that a cell holds at a time.
CELL_SCORES = 1 << 21
#: Double precision holds whole numbers exactly up to here.
EXACT = 1 << 53

POINTS = "vec_id bigint, label int, x array<bigint>"
PAIRS = "anchor_id bigint, score bigint, id bigint, positive boolean"
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def points(df: DataFrame, id_col: str, vector_col: str, label: Column, anchors: Column, scale: int) -> DataFrame:
    """``vec_id, label, x, anchor`` of the rows that take part, one for each id."""
    carried = {"vec_id": F.col(f"`{id_col}`").cast("bigint"), "label": label.cast("int"), "anchor": F.coalesce(anchors, F.lit(False))}
    rows = whole_vectors(df, F.col(f"`{vector_col}`"), carried, scale).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x", "anchor")).alias("p")).select("vec_id", "p.label", "p.x", "p.anchor")


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact."""
    width = max(anchors.shape[1], rows.shape[1])
    wide = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, rows)]
    if float(width) * float(np.abs(wide[0]).max(initial=0)) * float(np.abs(wide[1]).max(initial=0)) < EXACT:
        return (wide[0].astype(float) @ wide[1].astype(float).T).astype(np.int64)
    return wide[0] @ wide[1].T


def _firsts(scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest scores, equal ones in their order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def _in_cells(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], pick) -> DataFrame:
    """``PAIRS`` that ``pick(anchor, scores, same label, ids of the rows)`` keeps, ``(places, positive)``, cell by cell."""
    lines, columns = parts_for(counts[0], CELL_ROWS, 1), parts_for(counts[1], CELL_ANCHORS, 1)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(lines)).cast("int").alias("line"), "vec_id", "label", "x").withColumn("column", every(columns))
    right = anchors.withColumn("column", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(columns)).cast("int")).withColumn("line", every(lines))

    def meet(theirs: pa.Table, ours: pa.Table) -> pa.Table:
        theirs = theirs.sort_by("vec_id")
        ids, labels, x = theirs["vec_id"].to_numpy(), theirs["label"].to_numpy(), matrix(theirs["x"])
        out: list[tuple[np.ndarray, ...]] = []
        step = max(1, CELL_SCORES // max(1, len(ids)))
        for at in range(0, ours.num_rows if len(ids) else 0, step):
            some = ours.slice(at, step)
            scores = _scores(matrix(some["x"]), x)
            for anchor, s in zip(some.drop_columns(["x"]).to_pylist(), scores, strict=True):
                for places, positive in pick(anchor, s, labels == anchor["label"], ids):
                    out.append((np.full(len(places), anchor["vec_id"]), s[places], ids[places], np.full(len(places), positive)))
        columns_ = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        return pa.table(dict(zip(["anchor_id", "score", "id", "positive"], columns_, strict=True)))

    return left.groupBy("line", "column").cogroup(right.groupBy("line", "column")).applyInArrow(meet, PAIRS)


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.repartition(shuffle_parts(pairs.sparkSession), "anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), "id")


def first_positives(pairs: DataFrame, positives: int) -> DataFrame:
    """``anchor_id, found``: the first ``positives`` of each anchor's pairs, as an array of ``(score, id)`` in their order."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, left, out = None, 0, []
        for batch in batches:
            for a, s, i in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "score", "id")), strict=True):
                if a != anchor:
                    anchor, left = a, positives
                if left:
                    left -= 1
                    out.append((a, positives - left, s, i))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["anchor_id", "no", "score", "id"])
                out = []

    rows = _sorted_pairs(pairs).mapInArrow(walk, "anchor_id bigint, no bigint, score bigint, id bigint")
    ordered = F.array_sort(F.collect_list(F.struct("no", "score", "id")))  # at most `positives` of them
    return rows.groupBy("anchor_id").agg(F.transform(ordered, lambda p: F.struct(p["score"].alias("score"), p["id"].alias("id"))).alias("found"))


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores of a positive's negatives: those from ``low`` to ``high`` per cent of its own."""
    return -(-low * score // 100), high * score // 100


def mined_negatives(pairs: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """``MINED`` from ``PAIRS``, by one walk over the pairs of each anchor in descending order of their scores."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows, level, seen = None, [], None, []
        for batch in batches:
            out: list[tuple[int, ...]] = []
            for a, s, i, positive in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "score", "id", "positive")), strict=True):
                if a != anchor:
                    anchor, windows, level = a, [], None
                if s != level:
                    level, seen = s, []
                if positive:
                    least, most = window(s, low, high)
                    if least <= most:
                        # id, score, bounds, how many it has; negatives of this score with smaller ids came before.
                        windows.append(w := [i, s, least, most, 0])
                        for j in seen if least <= s <= most else ():
                            w[4] += 1
                            out.append((a, i, w[4], j, s, s))
                    continue
                if len(seen) < negatives:
                    seen.append(i)
                done = False
                for w in windows:
                    if w[2] <= s <= w[3] and w[4] < negatives:
                        w[4] += 1
                        out.append((a, w[0], w[4], i, w[1], s))
                    done = done or w[4] == negatives or s < w[2]
                if done:
                    windows = [w for w in windows if w[4] < negatives and s >= w[2]]
            if out:
                table = pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
                yield from table.set_column(2, "rank", table["rank"].cast(pa.int32())).to_batches()

    return _sorted_pairs(pairs).mapInArrow(walk, MINED)


def hard_negatives(
    df: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """``MINED``: for each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of other labels in its window.

    ``anchors`` (boolean) and ``label`` are columns over ``df``. A window is from ``low`` to ``high`` per cent of the positive's score.
    """
    if not 0 <= low < high <= 100:
        raise ValueError("low and high are per cent, low below high")
    rows = written(points(df, id_col, vector_col, label, anchors, scale))
    own = rows.filter("anchor").select("vec_id", "label", "x")
    counts = (rows.count(), own.count())
    if not counts[1]:
        return df.sparkSession.createDataFrame([], MINED)

    def same_label(anchor, scores, same, ids):
        others = np.flatnonzero(same & (ids != anchor["vec_id"]))
        yield others[_firsts(scores[others], positives)], True

    def in_windows(anchor, scores, same, ids):
        bounds = [window(p["score"], low, high) for p in anchor["found"]]
        bounds = [b for b in bounds if b[0] <= b[1]]
        if bounds:
            near = np.flatnonzero(~same & (scores >= min(b[0] for b in bounds)) & (scores <= max(b[1] for b in bounds)))
            places = [near[inside[_firsts(scores[near[inside]], negatives)]] for b in bounds for inside in [np.flatnonzero((scores[near] >= b[0]) & (scores[near] <= b[1]))]]
            yield np.unique(np.concatenate(places)), False

    found = written(first_positives(_in_cells(rows, own, counts, same_label), positives))
    with_windows = written(own.join(found.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    near = _in_cells(rows, with_windows, counts, in_windows)
    opened = found.select("anchor_id", F.inline("found")).select("anchor_id", "score", "id", F.lit(True).alias("positive"))
    return mined_negatives(opened.unionByName(near), negatives, low, high)
