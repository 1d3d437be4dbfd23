"""What the operators share: input frames, written intermediate tables, Arrow slices and worker-wide state."""

from __future__ import annotations

import contextlib
import math
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable

#: Text bytes that one step of vectorised work takes at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Text bytes that work with several numbers for each byte takes at once within a slice, as each byte costs about a hundred then.
STEP_BYTES = 512 << 10
#: Bytes of rows that Spark hands to Python at once within ``small_batches``; by itself it takes up to 64 MiB, held several times in JVM and worker.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id bigint, text string``; other columns go, a NULL text is empty."""
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text, so that rows with one id, or none, are kept apart."""
    return F.xxhash64(doc_id, text)


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffle_files_released(spark: SparkSession):
    """Within it, the shuffle files of a finished write are removed at once and not when the driver happens to collect garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession):
    """Within it, what runs hands rows to Python by ``BATCH_BYTES``, or one longer row alone."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, small: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors, its shuffle files gone.

    ``small`` is for Python functions over long rows that do not mind where a batch ends: see ``small_batches``.
    """
    with shuffle_files_released(df.sparkSession), small_batches(df.sparkSession) if small else contextlib.nullcontext():
        return durable(df)


def parts_for(units: float, each: float, least: int = 1) -> int:
    """How many parts of about ``each`` units hold ``units``."""
    return max(least, math.ceil(units / each))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object that lives as long as the Python worker, across tasks; functions sent by value have no module to keep it in."""
    home = sys.modules.setdefault("spanloom_worker_state", types.ModuleType("spanloom_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its rows in them; NULL is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no slice holds more than ``most`` bytes of text, except one longer row alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_steps(column: pa.Array) -> Iterator[pa.Array]:
    """A column of texts cut as by ``slices``, by ``STEP_BYTES``."""
    return (part.column(0) for part in slices([pa.RecordBatch.from_arrays([column], ["text"])], most=STEP_BYTES))


def ids_of(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(name)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and row lengths."""
    bounds = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose rows are the raw bytes of ``values[bounds[i]:bounds[i+1]]``."""
    offsets = (np.asarray(bounds) * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def packets(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket that occurs, with the bucket's values of each column as raw bytes in their order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    bounds = np.append(begins, len(bucket))
    return pa.RecordBatch.from_arrays([pa.array(bucket[begins], pa.int64()), *[binaries(v[order], bounds) for v in columns.values()]], ["bucket", *columns])


def raw(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    """All values of a column of raw bytes, one after the other; NULL has none."""
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal neighbours begin, and how long they are."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return begins, np.diff(np.append(begins, len(values)))
