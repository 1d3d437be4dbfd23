"""Writers. All output is UTF-8 with non-ASCII characters kept, one part file per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "error") -> None:
    """JSON lines under one folder per split."""
    df.write.mode(mode).partitionBy(split).json(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """Results, regularised annotations, predictions or metrics as JSON lines."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, keys: Sequence[str] | None = None, bom: bool = False, mode: str = "error") -> None:
    """Chosen columns as CSV with a header; with ``bom`` each file begins with a byte order mark."""
    out = df.select(*[F.col(f"`{k}`") for k in keys]) if keys else df
    if bom:
        first = out.columns[0]
        out = out.withColumnRenamed(first, "\ufeff" + first)
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_documents(df: DataFrame, path: str, split: str | None = None, mode: str = "error") -> None:
    """Shortened documents in the layout they came in."""
    write_splits(df, path, split, mode) if split else write_json(df, path, mode)
