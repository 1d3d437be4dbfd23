"""Seeded shuffles and train/dev/test splits of exact size."""

from __future__ import annotations

import os
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ERROR_NO_TRAIN, ERROR_RATIO_LENGTH, ERROR_RATIO_SUM, SEED, SPLIT_RATIO
from ..functions.common import seeded_hash
from ..session import durable

SPLITS = ("train", "dev", "test")

# A group of at most this many keys is ordered directly; larger ones are refined first, by so many hex digits.
DIRECT_ORDER = 100_000
PREFIX_STEP = 3


def check_ratio(ratio: Sequence[float], allow_empty: bool = False) -> None:
    if allow_empty and len(ratio) == 0:
        return
    if len(ratio) != 3:
        raise ValueError(ERROR_RATIO_LENGTH.format(n=len(ratio)))
    if sum(Decimal(str(r)) for r in ratio) != Decimal("1"):
        raise ValueError(ERROR_RATIO_SUM)


def seeded_shuffle(df: DataFrame, key: str, seed: int | str = SEED) -> DataFrame:
    """The rows in a repeatable random order."""
    return df.withColumn("__h", seeded_hash(seed, F.col(key))).orderBy("__h", key).drop("__h")


def order_digits(df: DataFrame, key: str) -> Column:
    """Hex digits whose order as strings is that of the key: whole numbers with a sign, strings (by bytes), dates, times, booleans.

    A NULL key stops the job: it has no place in the order.
    """
    kind, value = df.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        digits = F.hex(value.cast("binary"))
    elif isinstance(kind, (T.IntegralType, T.BooleanType)) or (isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18):
        digits = _signed(value.cast("bigint"))
    elif isinstance(kind, T.DateType):
        digits = _signed(F.unix_date(value).cast("bigint"))
    elif isinstance(kind, T.TimestampType):
        digits = _signed(F.unix_micros(value))
    else:
        raise ValueError(f"A key of type {kind.simpleString()} has no order of digits.")
    return _not_null(value, digits)


def _signed(number: Column) -> Column:
    """16 hex digits; with the sign bit turned, negative numbers come first."""
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def _not_null(value: Column, digits: Column) -> Column:
    return F.when(value.isNull(), F.raise_error(F.lit("A split needs a key in every row."))).otherwise(digits)


def _counts(keys: DataFrame, common: str) -> list[tuple[str, str, str, int]]:
    """``(prefix, first, last, n)`` of the keys that begin with ``common``, by their next digits, in order."""
    width = len(common) + PREFIX_STEP
    inside = keys.where(F.startswith("k", F.lit(common))) if common else keys
    rows = inside.groupBy(F.substring("k", 1, width).alias("p")).agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count(F.lit(1)).alias("n")).collect()  # at most 16**3 + 1
    return sorted((r["p"], r["a"], r["b"], r["n"]) for r in rows)


def _key_at(keys: DataFrame, groups: list[tuple[str, str, str, int]], position: int) -> str | None:
    """The key at a 0-based position; None past the end.

    A group is narrowed by the digits behind what its first and last key have in common, so long common beginnings cost no pass.
    """
    while True:
        for prefix, first, last, n in groups:
            if position < n:
                break
            position -= n
        else:
            return None
        if first == last:
            return first
        if n <= DIRECT_ORDER:
            return keys.where((F.col("k") >= first) & (F.col("k") <= last)).orderBy("k").offset(position).limit(1).collect()[0]["k"]
        groups = _counts(keys, os.path.commonprefix([first, last]))


def _assign(df: DataFrame, key: str, seed: int | str, shuffle: bool, cut_points, out: str) -> tuple[DataFrame, int, int, int]:
    order = _not_null(F.col(f"`{key}`"), seeded_hash(seed, F.col(f"`{key}`"))) if shuffle else order_digits(df, key)
    # The input is gone through once; counts and cuts read only its keys.
    keys = durable(df.select(order.alias("k")))
    groups = _counts(keys, "")
    if len(groups) == 1:
        groups = _counts(keys, os.path.commonprefix(groups[0][1:3]))
    n = sum(g[3] for g in groups)
    p1, p2 = cut_points(n)
    split = F.lit(SPLITS[2])
    for name, position in ((SPLITS[1], p2), (SPLITS[0], p1)):
        cut = _key_at(keys, groups, position)
        inside = F.lit(True) if cut is None else order < F.lit(cut)
        split = F.when(inside, F.lit(name)).otherwise(split)
    return df.withColumn(out, split), n, p1, p2


def split_extraction(
    df: DataFrame, key: str, ratio: Sequence[float] = tuple(SPLIT_RATIO), seed: int | str = SEED, shuffle: bool = True, out: str = "split"
) -> DataFrame:
    """Split by ratio with rounded (half-even) cut points; an empty train split is an error.

    The two cut positions are located in a table of the keys alone (counts by their first digits, then one small
    group), so the documents themselves are only compared with two literals and never move. Without ``shuffle`` the
    order is that of the key. Rows with one key are not parted.
    """
    check_ratio(ratio)
    split, _, p1, _ = _assign(
        df, key, seed, shuffle, lambda n: (round(n * ratio[0]), round(n * (ratio[0] + ratio[1]))), out
    )
    if p1 <= 0:
        raise ValueError(ERROR_NO_TRAIN.format(n=p1))
    return split


def split_classification(
    df: DataFrame, key: str, ratio: Sequence[float] = tuple(SPLIT_RATIO), seed: int | str = SEED, shuffle: bool = True, out: str = "split"
) -> DataFrame:
    """Split by ratio with truncated cut points; an empty ratio puts everything into train."""
    check_ratio(ratio, allow_empty=True)
    if len(ratio) == 0:
        return df.withColumn(out, F.lit(SPLITS[0]))
    return _assign(df, key, seed, shuffle, lambda n: (int(n * ratio[0]), int(n * (ratio[0] + ratio[1]))), out)[0]


def fill_empty_splits(examples: DataFrame, split: str = "split") -> DataFrame:
    """An empty train split takes the rows of dev (or test), an empty dev split those of test."""
    train, dev, test = (not examples.where(F.col(split) == s).isEmpty() for s in SPLITS)
    parts = [examples]

    def copy(source: str, target: str) -> DataFrame:
        return examples.where(F.col(split) == source).withColumn(split, F.lit(target))

    if not train and (dev or test):
        parts.append(copy(SPLITS[1] if dev else SPLITS[2], SPLITS[0]))
    if not dev and test:
        parts.append(copy(SPLITS[2], SPLITS[1]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
