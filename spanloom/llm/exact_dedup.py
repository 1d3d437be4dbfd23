"""Exact dedup by content sort, with DataFrame functions only.

Sampled splitters deal the normalised texts into ranges, an external sort puts equal texts side by side, and each
text is compared in full with its neighbour. Splitters are the leading bytes with a fingerprint of the whole text,
so what is sampled stays small. A text that more than a small share of all rows has is dealt over several ranges;
what is left of it there, one row each, is sorted once more.

Cases: a NULL text counts as empty; of rows with one text and one id exactly one stays; a NULL id is the smallest;
very long texts are compared in full; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, written

#: Bytes of text in the splitters.
LEAD = 48
#: A text is hot when more than one row in so many has it: fewer than this many texts are.
HOT_SHARE = 20_000
#: A text with no more rows than this is never hot.
HOT_ROWS = 256
#: Rows that one task sorts.
SORT_ROWS = 20_000


def _sorted_groups(rows: DataFrame, parts: int, stays: Column) -> DataFrame:
    """``rows (doc_id, body, lead, code, salt, …)`` with ``part``: the number of their text among those with the same ``lead, code, salt``."""
    ranged = rows.repartitionByRange(parts, "lead", "code", "salt")
    order = Window.partitionBy("lead", "code", "salt").orderBy("body", stays)
    # A text equal to the one before it in this order is of the same group.
    starts = ranged.withColumn("starts", (~F.col("body").eqNullSafe(F.lag("body").over(order))).cast("int"))
    return starts.withColumn("part", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def _dealt(docs: DataFrame, text_col: str, normalise, carried: list[Column], n: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary and those of hot texts, if there are any, with ``body, lead, code, salt``."""
    body = normalise(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = docs.select(body.alias("body"), *carried)
    rows = rows.select("*", F.substring(F.encode("body", "utf-8"), 1, LEAD).alias("lead"), F.xxhash64("body").alias("code"))
    most = max(HOT_ROWS, n // HOT_SHARE)
    hot = rows.groupBy("code").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("code", F.ceil(F.col("n") / most).cast("int").alias("salts"))
    hot = written(hot.coalesce(1))  # fewer than HOT_SHARE rows, by the share that each of them has
    if hot.isEmpty():
        return rows.withColumn("salt", F.lit(0)), None
    rows = rows.join(F.broadcast(hot), "code", "left")
    salted = rows.filter("salts IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("salts")).cast("int"))
    return rows.filter("salts IS NULL").drop("salts").withColumn("salt", F.lit(0)), salted.drop("salts")


def _stays(keep: str) -> Column:
    """The order in which the first row of a text stays."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    return F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_first()


def exact_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=lambda text: text) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stays, n = _stays(keep), docs.count()
    row = F.struct(F.lit(True).alias("is_row"), *[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    carried = [F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), row, F.col(f"`{text_col}`").alias("own")]
    rows, hot = _dealt(docs, text_col, normalise, carried, n)
    kept = _sorted_groups(rows, parts_for(n, SORT_ROWS), stays).filter("starts = 1").select("row", "own")
    if hot is not None:
        # One row for each part of a hot text: a second sort leaves one for each text.
        firsts = _sorted_groups(hot, parts_for(n, SORT_ROWS), stays).filter("starts = 1").select("doc_id", "row", "own", "body", "lead", "code", F.lit(0).alias("salt"))
        kept = kept.union(_sorted_groups(firsts, 8, stays).filter("starts = 1").select("row", "own"))
    kept = kept.coalesce(parts_for(n, SORT_ROWS))
    return kept.select(*[F.col("own").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _numbered(rows: DataFrame, parts: int, stays: Column) -> DataFrame:
    """``doc_id, lead, code, salt, part, text_sha256, place, keep_id, group_size`` and, in the first place only, ``body``."""
    groups = _sorted_groups(rows, parts, stays)
    slim = groups.select("doc_id", "lead", "code", "salt", "part", F.sha2("body", 256).alias("text_sha256"), F.when(F.col("starts") == 1, F.col("body")).alias("body"))
    whole = Window.partitionBy("lead", "code", "salt", "part")
    first = whole.orderBy(stays)
    return slim.select(
        "doc_id", "lead", "code", "salt", "part", "text_sha256", "body", F.row_number().over(first).alias("place"),
        F.first("doc_id").over(first).alias("keep_id"), F.count("*").over(whole).alias("group_size"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=lambda text: text) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row; ``normalise`` says which texts count as equal."""
    stays, n = _stays(keep), docs.count()
    parts = parts_for(n, SORT_ROWS)
    rows, hot = _dealt(docs, text_col, normalise, [F.col(f"`{id_col}`").cast("bigint").alias("doc_id")], n)
    done = _numbered(rows, parts, stays).select("doc_id", "keep_id", "group_size", (F.col("place") == 1).alias("kept"), "text_sha256")
    if hot is not None:
        placed = written(_numbered(hot, parts, stays).coalesce(parts))
        # One row for each part of a hot text, at most as many as hot texts have salts; a second sort joins the parts.
        tops = placed.filter("place = 1").select("body", "lead", "code", F.lit(0).alias("salt"), F.col("salt").alias("own_salt"), F.col("part").alias("own_part"), F.col("keep_id").alias("doc_id"), "group_size")
        again = _sorted_groups(tops, 8, stays)
        together = Window.partitionBy("lead", "code", "part")
        merged = again.select(
            "code", F.col("own_salt").alias("salt"), F.col("own_part").alias("part"),
            F.first("doc_id").over(together.orderBy(stays)).alias("all_keep"), F.row_number().over(together.orderBy(stays)).alias("all_place"),
            F.sum("group_size").over(together).alias("all_size"),
        )
        joined = placed.join(F.broadcast(merged), ["code", "salt", "part"])
        done = done.union(joined.select("doc_id", F.col("all_keep").alias("keep_id"), F.col("all_size").alias("group_size"), ((F.col("place") == 1) & (F.col("all_place") == 1)).alias("kept"), "text_sha256"))
    return done.coalesce(parts)
