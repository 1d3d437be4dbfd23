"""Token ids as Parquet files: one list column, dictionary-encoded, in ascending order of the document ids.

Row groups and pages are small and indexed, so a reader takes single documents, or the counts without the ids.

Cases: a NULL or empty text is its end id alone; rows without an id come first; repeated rows are written each, ties
in the order of a hash of the text; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import id_and_text, lists, shuffle_files_released, shuffle_parts, slices
from .encoding import encoder

_FILE = "part int, doc_id bigint, n_tokens bigint, part_start bigint, ids array<int>"


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, files: int | None = None,
    row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write ``part, doc_id, n_tokens, part_start, ids``: a file for each range of ids, in order within it.

    ``part_start`` counts the ids before the document in its own file.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for piece in slices(batches):
            flat, counts = encoder(vocabulary).encode(piece.column("text"))
            totals = counts + 1
            ends = np.cumsum(totals)
            ids = np.full(int(ends[-1]), end_id, np.int32)
            own = np.ones(len(ids), bool)
            own[ends - 1] = False
            ids[own] = flat
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(totals), part), pa.int32()), piece.column("doc_id"), pa.array(totals, pa.int64()), pa.array(before + ends - totals, pa.int64()), lists(ids, totals, pa.int32())],
                ["part", "doc_id", "n_tokens", "part_start", "ids"],
            )
            before += int(ends[-1])

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange(files or shuffle_parts(docs.sparkSession), "doc_id")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    writer = ordered.mapInArrow(encode, _FILE).write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    with shuffle_files_released(docs.sparkSession):
        writer.option("parquet.page.row.count.limit", page_rows).option("parquet.enable.dictionary", "true").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: ``start`` counts the ids of all documents before, from the counts alone."""
    rows = spark.read.schema(_FILE).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file.
    bases = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def id_checksums(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids_crc32`` over the ids as little-endian unsigned 32-bit numbers in place of the ids."""
    others = [c for c in rows.columns if c != "ids"]
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            flat, bounds = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(crc, pa.int64())], [*others, "ids_crc32"])

    return rows.select(*others, "ids").mapInArrow(sums, ", ".join([*kinds, "ids_crc32 bigint"]))


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files, reached by all executors."""
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
