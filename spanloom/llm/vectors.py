"""Embeddings as vectors of whole numbers, and sums over such vectors in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers that one step of vectorised work takes at once.
STEP_VALUES = 1 << 20


def whole_vectors(df: DataFrame, vector: Column, carried: dict[str, Column], scale: int, offset: int = 0, bound: int = 1 << 27) -> DataFrame:
    """The carried columns and ``x array<bigint>``: ``floor(scale * c) + offset`` of each component ``c`` as double.

    Rows whose vector is NULL, or holds a NULL or a number that isn't finite, are left out. Components saturate at
    ``bound`` either way.
    """
    rows = df.select(*[c.alias(name) for name, c in carried.items()], vector.cast("array<double>").alias("x"))
    names = list(carried)
    schema = rows.drop("x").schema.add("x", T.ArrayType(T.LongType()))

    def convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("x")
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            values = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = column.is_valid().to_numpy(zero_copy_only=False) & (odd[bounds[1:]] == odd[bounds[:-1]])
            whole = np.clip(np.floor(np.where(np.isfinite(values), values, 0.0) * scale) + offset, -bound, bound).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(whole))
            out = pa.RecordBatch.from_arrays([*[batch.column(name) for name in names], lists], [*names, "x"])
            yield out.filter(pa.array(good))

    return rows.mapInArrow(convert, schema)


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """The lists of a column as rows of a matrix; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0)) if width is None else width
    if np.all(lengths == width):
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def row_steps(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no step has more than ``STEP_VALUES`` numbers."""
    step = max(1, STEP_VALUES // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def vector_sums(partials: DataFrame, parts: int) -> DataFrame:
    """``at, v``: the sums of the vectors ``v`` with equal ``at``. Each task holds one vector for each ``at`` it gets."""

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, v in zip(batch.column("at").to_pylist(), matrix(batch.column("v")), strict=True):
                sums[at] = sums[at] + v if at in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["at", "v"])

    return partials.repartition(parts, "at").mapInArrow(add_up, "at int, v array<double>")
