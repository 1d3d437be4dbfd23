"""Packing: documents as token pieces in sequences of a fixed length, by best-fit decreasing.

Cases: a NULL or empty text is its end id alone; a document longer than a sequence is first cut into full windows,
and its rest is a piece like any other; repeated rows and equal lengths are packed each for itself, in the order of
their ids; a NULL id is packed too; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, lists, parts_for, slices, written
from .encoding import encoder

#: Pieces that one task packs together. A group leaves about one window half full.
GROUP_PIECES = 50_000
_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of each document: full windows of ``capacity`` ids from its start on, then the rest; with the ids if asked for."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            flat, counts = encoder(vocabulary).encode(part.column("text"))
            totals = counts + 1
            ids = np.empty(int(totals.sum()), "<u4")
            ends = np.cumsum(totals)
            own = np.ones(len(ids), bool)
            own[ends - 1] = False
            ids[own], ids[ends - 1] = flat, end_id
            pieces = -(-totals // capacity)
            row = np.repeat(np.arange(len(totals)), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(capacity, totals[row] - start)
            at = (ends - totals)[row] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = [part.column("doc_id").take(pa.array(row)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(totals[row], pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, lists(ids.astype(np.int32), length, pa.int32())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return id_and_text(docs, id_col, text_col).mapInArrow(cut, _PIECE + (", ids array<int>" if with_ids else ""))


class OpenWindows:
    """Open windows by their remaining capacity, in a segment tree that finds the least capacity of at least ``n``."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, window: int, left: int) -> None:
        self.windows[left].append(window)
        node = self.leaves + left
        while node and not self.open[node]:
            self.open[node] = True
            node //= 2

    def take(self, n: int) -> tuple[int, int] | None:
        """The tightest window with room for ``n`` and its remaining capacity; it is open no more."""
        node, tree = self.leaves + n, self.open
        if not tree[node]:
            while node & 1 or not tree[node + 1]:  # up, until a right neighbour holds something
                node //= 2
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        left = node - self.leaves
        window = self.windows[left].pop()
        if not self.windows[left]:
            tree[node] = False
            while node > 1 and not tree[node ^ 1]:
                node //= 2
                tree[node] = False
        return window, left


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``(window, offset)`` of each piece; the lengths are given in falling order."""
    opened, made = OpenWindows(capacity), 0
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        found = opened.take(n)
        if found is None:
            found, made = (made, capacity), made + 1
        window[i], offset[i] = found[0], capacity - found[1]
        if found[1] > n:
            opened.add(found[0], found[1] - n)
    return window, offset


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    The pieces are dealt by a hash into groups of about ``group_pieces``, each packed by itself in one task, so no
    task grows with the data. ``pieces`` should be a written table: it is counted first.
    """
    groups = parts_for(pieces.count(), group_pieces)

    def place(table: pa.Table) -> pa.Table:
        own = np.lexsort([table[c].fill_null(-1).to_numpy() for c in ("ids_crc32", "start", "doc_id")] + [-table["length"].to_numpy()])
        table = table.take(pa.array(own))
        window, offset = best_fit_decreasing(table["length"].to_numpy(), capacity)
        group = table["packing_group"].to_numpy()
        table = table.drop_columns(["packing_group"])
        return table.append_column("sequence_id", pa.array(window * groups + group, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    dealt = pieces.withColumn("packing_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInArrow(place, ", ".join([*kept, "sequence_id bigint", "`offset` bigint"]))


def packed_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each piece of each document with its place; texts are encoded once."""
    return pack(written(token_pieces(docs, vocabulary, end_id, capacity, False, id_col, text_col), small=True), capacity)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_starts`` from placed pieces that carry their ids; a sequence holds at most its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("doc_starts"))
