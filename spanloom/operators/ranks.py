"""Global order without a global sort in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import seeded_hash
from ..session import durable

# The number of buckets is 16 to this power: a fixed bound on what is broadcast back.
HASH_DIGITS = 3


def seeded_rank(df: DataFrame, key: str, seed: int | str, out: str = "rank", digits: int = HASH_DIGITS) -> DataFrame:
    """0-based position of each row in a repeatable random order of its unique ``key``.

    Rows are bucketed by the first hash digits, which are uniform whatever the keys are; bucket counts
    (at most 16**digits rows) are added up and broadcast; the rest of the order is local to a bucket.
    """
    hashed = df.withColumn("__h", seeded_hash(seed, F.col(key))).withColumn("__b", F.substring("__h", 1, digits))
    # Runs over the bucket counts only.
    offsets = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")).select(
        "__b",
        (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__before"),
    )
    local = F.row_number().over(Window.partitionBy("__b").orderBy("__h", key)) - 1
    return (
        hashed.join(F.broadcast(offsets), "__b")
        .withColumn(out, (F.col("__before") + local).cast("bigint"))
        .drop("__b", "__h", "__before")
    )


def running_totals(df: DataFrame, key: str, weights: Mapping[str, Column], parts: int | None = None) -> DataFrame:
    """``(key, *names)``: for each named weight its sum over all rows with a smaller unique ``key``.

    Only keys and weights are range-partitioned; the per-partition sums (one row per partition) are added
    up and broadcast back.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = df.select(F.col(key), *[w.cast("bigint").alias(name) for name, w in weights.items()])
    ranged = durable(narrow.repartitionByRange(n, key).withColumn("__p", F.spark_partition_id()))
    sums = ranged.groupBy("__p").agg(*[F.sum(name).alias(f"__s_{name}") for name in weights])
    earlier = Window.orderBy("__p")
    offsets = sums.select("__p", *[(F.sum(f"__s_{name}").over(earlier) - F.col(f"__s_{name}")).alias(f"__o_{name}") for name in weights])
    inside = Window.partitionBy("__p").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(offsets), "__p").select(
        key,
        *[(F.col(f"__o_{name}") + F.coalesce(F.sum(name).over(inside), F.lit(0))).cast("bigint").alias(name) for name in weights],
    )


def row_ids(df: DataFrame, key: str, first: int = 0, out: str = "row_id") -> DataFrame:
    """``(key, out)``: consecutive numbers in the order of a unique key."""
    return running_totals(df, key, {out: F.lit(1)}).withColumn(out, F.col(out) + first)
