"""Whitening of embeddings by a weighted covariance over their distinct vectors.

Equal vectors of whole numbers are grouped, and their counts (or one) are the fit weights. Each task adds up the
weighted products of its centred vectors by matrix multiplication and hands over one matrix, row by row; the rows are
added up in Spark, and only the covariance itself, whose size follows from the dimension, comes to the driver. Each
distinct vector is whitened once and joined back to the rows that have it. Vectors that many rows have are joined by
broadcast; their number has a bound that follows from the share of rows that each has.

Cases: rows whose vector is NULL or holds a NULL or a number that isn't finite are left out; of vectors of several
dimensions those of the commonest take part (of equally common ones the largest), empty vectors never; components
that no longer fit saturate at 2^50; equal vectors and repeated rows all count, each row is returned; directions
without variance (an eigenvalue within rounding of zero) give no component, so a single vector gives no rows; equal
eigenvalues are numbered in the order of the decomposition; ``deviation`` is NULL where it doesn't fit a long; an
empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_parts, written
from .vectors import matrix, row_steps, vector_sums, whole_vectors

#: A vector is hot when more than one row in so many has it: fewer than this many vectors are.
HOT_SHARE = 1_000
#: A vector with no more rows than this is never hot.
HOT_ROWS = 100
#: The largest whole number that products may reach in 64-bit arithmetic; beyond it Python's own numbers are used.
SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What was learnt from ``n`` vectors (weights added up) with the sums ``total`` by dimension."""

    n: int
    total: list[int]
    vectors: np.ndarray  # a column for each component, divided by the root of its eigenvalue
    values: np.ndarray
    trace: float


def _gathered(df: DataFrame, column: str, names: list[str], types: str, step) -> DataFrame:
    """One answer of ``step(matrices and weights)`` for each task, as rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        width = len(first.column(column)[0])

        def pieces():
            yield from row_steps([first], width)
            yield from row_steps(batches, width)

        rows = step((matrix(b.column(column)), b.column("weight").to_numpy(zero_copy_only=False)) for b in pieces())
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    return df.select(column, "weight").mapInArrow(run, types)


def exact_totals(distinct: DataFrame) -> list[int]:
    """The weighted sum of ``x`` in each dimension."""

    def step(pieces):
        total: np.ndarray | None = None
        for x, w in pieces:
            safe = float(np.abs(x).max(initial=0)) * float(w.sum()) < SAFE
            part = (x * w[:, None]).sum(axis=0) if safe else (x.astype(object) * w.astype(object)[:, None]).sum(axis=0)
            total = part.astype(object) + (0 if total is None else total)
        return [(at, int(s) >> 40, int(s) & ((1 << 40) - 1)) for at, s in enumerate(total)]

    rows = _gathered(distinct, "x", ["at", "high", "low"], "at int, high bigint, low bigint", _int32_first(step))
    sums = rows.groupBy("at").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    found = {r["at"]: (int(r["high"]) << 40) + int(r["low"]) for r in sums.collect()}
    return [found[at] for at in range(len(found))]


def _int32_first(step):
    """Numpy's small integers for the first column of a step's rows."""
    return lambda pieces: [(np.int32(at), *rest) for at, *rest in step(pieces)]


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``n * x - total``, exact: whole numbers of 64 bits, or Python's own where these are too small."""
    most = max([abs(t) for t in total], default=0) + n * int(np.abs(x).max(initial=0))
    if most < SAFE:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def covariance(distinct: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Of ``distinct (x, weight)``, about the mean ``total / n`` with divisor ``n``."""

    def step(pieces):
        out: np.ndarray | None = None
        for x, w in pieces:
            y = (deviations(x, n, total) / n).astype(float)
            part = (y * w[:, None]).T @ y
            out = part if out is None else out + part
        return [(np.int32(at), row) for at, row in enumerate(out)]

    partials = _gathered(distinct, "x", ["at", "v"], "at int, v array<double>", step)
    parts = min(max(1, len(total)), shuffle_parts(distinct.sparkSession))
    rows = {r["at"]: r["v"] for r in vector_sums(partials, parts).collect()}
    return np.array([rows[at] for at in range(len(total))]) / n


def fitted(distinct: DataFrame, components: int) -> Whitening | None:
    """The whitening of ``distinct (x, weight)``; None if it has no rows."""
    n = distinct.agg(F.sum("weight")).first()[0]
    if not n:
        return None
    total = exact_totals(distinct)
    v = covariance(distinct, n, total)
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > max(values[0], 0.0) * len(total) * np.finfo(float).eps * 8).sum()))
    return Whitening(n, total, vectors[:, :kept] / np.sqrt(values[:kept]), values[:kept], float(values.sum()))


def whitened_vectors(distinct: DataFrame, model: Whitening) -> DataFrame:
    """``distinct`` with ``deviation bigint`` and ``whitened array<double>``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_steps(batches, len(model.total)):
            y = deviations(matrix(batch.column("x"), len(model.total)), model.n, model.total)
            if float(len(model.total)) * float(np.abs(y).max(initial=0)) ** 2 < SAFE:
                deviation = (y * y).sum(axis=1).tolist()
            else:
                deviation = [int(s) if s < 1 << 63 else None for s in (y.astype(object) ** 2).sum(axis=1)]
            white = (y / model.n).astype(float) @ model.vectors
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(deviation, pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))], [*batch.schema.names, "deviation", "whitened"]
            )

    return distinct.mapInArrow(run, T.StructType([*distinct.schema, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]))


def identity_error(white: DataFrame, n: int) -> float:
    """The largest entry of the covariance of ``whitened``, less the identity, in ``white (whitened, weight)``."""

    def sums(pieces):
        return [(np.int32(0), sum((y * w[:, None]).sum(axis=0) for y, w in pieces))]

    mean = np.array(vector_sums(_gathered(white, "whitened", ["at", "v"], "at int, v array<double>", sums), 1).first()["v"]) / n

    def products(pieces):
        total = sum(((y - mean) * w[:, None]).T @ (y - mean) for y, w in pieces)
        return [(np.int32(at), row) for at, row in enumerate(total)]

    rows = {r["at"]: r["v"] for r in vector_sums(_gathered(white, "whitened", ["at", "v"], "at int, v array<double>", products), len(mean)).collect()}
    return float(np.abs(np.array([rows[at] for at in range(len(mean))]) / n - np.eye(len(mean))).max())


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, scale: int = 1024, offset: int = 100_000, weights: str = "counts") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row that takes part and each component.

    With ``weights="counts"`` a distinct vector counts as often as it occurs, with ``"one"`` once.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights is counts or one, not {weights}")
    rows = written(whole_vectors(df, F.col(f"`{vector_col}`"), {"vec_id": F.col(f"`{id_col}`")}, scale, offset, bound=1 << 50))
    kinds = {"component": T.IntegerType(), "n": T.LongType(), "deviation": T.LongType(), "whitened": T.DoubleType(), "explained": T.DoubleType(), "identity_error": T.DoubleType()}
    schema = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), *[T.StructField(name, kind) for name, kind in kinds.items()]])
    common = rows.groupBy(F.size("x").alias("d")).count().filter("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == common["d"])
    counted = rows.groupBy("x").agg(F.count("*").alias("copies"))
    distinct = written(counted.withColumn("weight", F.col("copies") if weights == "counts" else F.lit(1).cast("bigint")))
    model = fitted(distinct, components)
    if not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    white = written(whitened_vectors(distinct, model))
    error = identity_error(white, model.n)
    found = white.select("x", "copies", "deviation", "whitened")
    many = F.col("copies") > max(HOT_ROWS, common["count"] // HOT_SHARE)
    hot, cold = F.broadcast(found.filter(many)), found.filter(~many)
    # Rows of hot vectors stay where they are; of the others no vector has many rows.
    joined = rows.join(hot, "x").unionByName(rows.join(hot.select("x"), "x", "left_anti").join(cold, "x"))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return joined.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
