"""Natural inner join of two result sets on all common columns, NULL equal to NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ERROR_MERGE_INPUT, ERROR_MERGE_OUTPUT
from ..session import durable

# A key is hot when it holds more than one part in this many of its table; so there are at most as many hot keys.
HOT_PARTS = 1000


def expand_labels(df: DataFrame, labels: Sequence[str], column: str = "pred_labels") -> DataFrame:
    """One column per label instead of the label map."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != column], *[F.col(column)[label].alias(label) for label in labels])


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    shared = set(right.columns)
    return [c for c in left.columns if c in shared]


def _align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in right.schema.fields}
    return left.withColumns({k: F.col(f"`{k}`").cast(types[k]) for k in keys})


def key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key value the rows of either side. A union and one aggregation, so hot keys combine before the shuffle."""
    columns = [F.col(f"`{k}`") for k in keys]
    both = left.select(*columns, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*columns, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return both.groupBy(*columns).agg(F.sum("__l").alias("left_rows"), F.sum("__r").alias("right_rows"))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.col("left_rows").cast("decimal(19,0)") * F.col("right_rows").cast("decimal(19,0)")), F.lit(0)).try_cast("bigint").alias("merged_rows"),
    )


def merge_guard(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows of both sides and of their join, computed from key counts without joining."""
    keys = list(keys or common_columns(left, right))
    return _totals(key_counts(_align(left, right, keys), right, keys))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    left, right = left.alias("l"), right.alias("r")
    condition: Column = reduce(lambda a, b: a & b, [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys])
    rest = [c for c in right.columns if c not in set(keys)]
    return left.join(right, condition, "inner").select("l.*", *[F.col(f"r.`{c}`") for c in rest])


def merge_results(left: DataFrame, right: DataFrame, validate: bool = True) -> DataFrame:
    """Join on all common columns; left keys take the type of the right ones.

    With ``validate`` the inputs must have equally many rows and the join as many as the left input. The
    check also finds hot keys; a valid merge has few rows on the other side of them, and these are
    broadcast, while all other keys are spread by the shuffle.
    """
    keys = common_columns(left, right)
    if not keys:
        raise ValueError("The two result sets have no column in common.")
    left = _align(left, right, keys)
    if not validate:
        return _null_safe_join(left, right, keys)

    # Read for the check and again for the hot keys.
    counts = durable(key_counts(left, right, keys))
    sizes = _totals(counts).first()
    n, m, merged = sizes["left_rows"], sizes["right_rows"], sizes["merged_rows"]
    if n != m:
        raise ValueError(ERROR_MERGE_INPUT.format(left=n, right=m))
    if n != merged:
        raise ValueError(ERROR_MERGE_OUTPUT.format(left=n, merged=merged))
    return _split_hot_join(left, right, keys, counts, n)


def _split_hot_join(left: DataFrame, right: DataFrame, keys: Sequence[str], counts: DataFrame, n: int) -> DataFrame:
    """Join whose result has ``n`` rows, as both inputs do.

    A key with more than n/HOT_PARTS rows on one side can have at most HOT_PARTS rows on the other side
    over all such keys together (their products sum to at most n), which bounds what is broadcast. There are
    at most HOT_PARTS such keys per side.
    """
    hot = counts.where(
        (F.greatest("left_rows", "right_rows") > max(n // HOT_PARTS, 1)) & (F.least("left_rows", "right_rows") > 0)
    )
    heavy = hot.collect()
    if not heavy:
        return _null_safe_join(left, right, keys)
    schema = left.select(*[F.col(f"`{k}`") for k in keys]).schema

    def frame(rows: list) -> DataFrame:
        return left.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in rows], schema)

    on_left = [r for r in heavy if r["left_rows"] >= r["right_rows"]]
    on_right = [r for r in heavy if r["left_rows"] < r["right_rows"]]
    all_hot = frame(heavy)

    def keep(df: DataFrame, values: DataFrame, how: str) -> DataFrame:
        d, v = df.alias("d"), F.broadcast(values).alias("v")
        condition = reduce(lambda a, b: a & b, [F.col(f"d.`{k}`").eqNullSafe(F.col(f"v.`{k}`")) for k in keys])
        return d.join(v, condition, how)

    parts = [_null_safe_join(keep(left, all_hot, "left_anti"), keep(right, all_hot, "left_anti"), keys)]
    if on_left:
        hot_keys = frame(on_left)
        parts.append(_null_safe_join(keep(left, hot_keys, "left_semi"), F.broadcast(keep(right, hot_keys, "left_semi")), keys))
    if on_right:
        hot_keys = frame(on_right)
        parts.append(_null_safe_join(F.broadcast(keep(left, hot_keys, "left_semi")), keep(right, hot_keys, "left_semi"), keys))
    return reduce(lambda a, b: a.unionByName(b), parts)
