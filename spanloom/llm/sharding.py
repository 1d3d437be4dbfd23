"""Sharding by fixed virtual slots: a record's slot is a hash of its id, and a versioned map says which shard holds a slot.

Only the map changes when shards are rebalanced or added; it has one row for each slot, at every size of the data.

Cases: a NULL text has no bytes; a NULL id has a slot like any other id; repeated rows share a slot and are counted
each; equal loads go to the lower slot and shard; an empty table has a map and no rows; further columns are kept out.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder

#: Virtual slots. Loads are gathered by slot, so this bounds what the driver sees.
SLOTS = 8192
#: Bytes that a record takes besides its text.
RECORD_BYTES = 8
_MAP = "version int, slot int, shard int, slot_bytes bigint, slot_rows bigint, first_row bigint"


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``."""
    text, key = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`").cast("bigint")
    size = F.octet_length(text).cast("bigint") + RECORD_BYTES
    return docs.select(key.alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"), slot_of(key, slots).alias("virtual_slot"))


def slot_loads(rows: DataFrame) -> list[tuple[int, int, int]]:
    """``(slot, bytes, rows)`` of the slots that hold something; at most one entry for each slot."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    return sorted((r["virtual_slot"], r["b"], r["n"]) for r in found)


def rebalanced(loads: list[tuple[int, int, int]], shards: int, before: dict[int, int] | None = None, slots: int = SLOTS) -> dict[int, int]:
    """A shard for each slot, near equal in bytes.

    Without a former map the largest slots go first, each to the lightest shard. With one, only slots of shards above
    the mean move, each to the lightest shard, as long as that evens them out.
    """
    load = {s: b for s, b, _ in loads}
    order = sorted(range(slots), key=lambda s: (-load.get(s, 0), s))
    weight, placed = [0] * shards, dict(before or {})
    if before is None:
        light = [(0, k) for k in range(shards)]
        for s in order:
            w, k = heapq.heappop(light)
            placed[s] = k
            heapq.heappush(light, (w + load.get(s, 0), k))
        return placed
    for s in order:
        weight[placed[s]] += load.get(s, 0)
    mean = sum(weight) / shards
    for s in order:
        k, to, b = placed[s], min(range(shards), key=lambda k: (weight[k], k)), load.get(s, 0)
        if b and weight[k] > mean and weight[to] + b < weight[k]:
            placed[s] = to
            weight[k], weight[to] = weight[k] - b, weight[to] + b
    return placed


def map_rows(version: int, placed: dict[int, int], loads: list[tuple[int, int, int]]) -> list[tuple]:
    """The rows of a map; ``first_row`` is where a slot's records begin within their shard."""
    load = {s: (b, n) for s, b, n in loads}
    filled: dict[int, int] = {}
    rows = []
    for s in sorted(placed):
        b, n = load.get(s, (0, 0))
        rows.append((version, s, placed[s], b, n, filled.get(placed[s], 0)))
        filled[placed[s]] = filled.get(placed[s], 0) + n
    return rows


def store_map(spark: SparkSession, path: str, rows: list[tuple]) -> DataFrame:
    """Add a version to the stored map; versions are never changed."""
    frame = spark.createDataFrame(rows, _MAP).coalesce(1)
    frame.write.mode("append").partitionBy("version").parquet(path)
    return read_map(spark, path, rows[0][0])


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(_MAP).parquet(path).filter(F.col("version") == version)


def map_folder(spark: SparkSession) -> str:
    import uuid

    return f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"


def assigned(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The records with ``shard`` and ``slot``, their place in the shard from 0 on.

    Records are numbered within their virtual slot, so the work is spread over thousands of groups; where a slot
    begins is in the map. The map has a fixed number of rows and is broadcast.
    """
    number = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32"))
    small = slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "first_row", "version")
    placed = rows.withColumn("n", number).join(F.broadcast(small), "virtual_slot")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("first_row") + F.col("n") - 1).alias("slot"), "virtual_slot", F.col("version").alias("map_version"))


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Build and store the first version of a map from the loads and apply it."""
    rows = records(docs, id_col, text_col, slots)
    loads = slot_loads(rows)
    first = map_rows(1, rebalanced(loads, shards, None, slots), loads)
    return assigned(rows, store_map(docs.sparkSession, path or map_folder(docs.sparkSession), first))


def resharded(docs: DataFrame, path: str, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Edit the last version of the stored map by the loads of ``docs``, store it as the next one and apply it.

    Slots move only off shards above the mean, and off shards that are no more; ``shards`` is the former number if not given.
    """
    versions = docs.sparkSession.read.schema(_MAP).parquet(path)
    last = versions.agg(F.max("version")).first()[0]
    before = {r["slot"]: r["shard"] for r in read_map(docs.sparkSession, path, last).collect()}  # one row for each slot
    shards = shards or max(before.values()) + 1
    rows = records(docs, id_col, text_col, slots)
    loads = slot_loads(rows)
    kept = {s: k if k < shards else s % shards for s, k in before.items()}
    return assigned(rows, store_map(docs.sparkSession, path, map_rows(last + 1, rebalanced(loads, shards, kept, slots), loads)))


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, id_col: str = "doc_id", slots: int = SLOTS) -> None:
    """The documents in one folder for each shard; a shard's slots may be written by several tasks."""
    small = slot_map.select(F.col("slot").alias("__slot"), F.col("shard"))
    placed = docs.withColumn("__slot", slot_of(F.col(f"`{id_col}`").cast("bigint"), slots)).join(F.broadcast(small), "__slot")
    placed.repartition("shard", "__slot").drop("__slot").write.partitionBy("shard").parquet(path)
