"""Shrinking a document to windows around its spans, within a character budget."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SHRINK_THRESHOLD
from ..functions.common import half_even, let, slice_of, stable_sort_by
from ..functions.rules import Rule
from ..functions.text import truncate
from ..schemas import SPANS
from .spans import rules_where_empty

WINDOWS = "array<struct<start:int,end:int>>"


def greedy_distinct(spans: Column, threshold: float = 0.0) -> Column:
    """In order, keep a span above the threshold whose start and end no kept span has.

    A span whose start and end no other has is kept at once; only the others are gone through in order.
    """
    numbered = F.transform(F.filter(spans, lambda s: s["probability"] > threshold).cast(SPANS), lambda s, i: F.struct(i.alias("i"), s.alias("s")))

    def twice(all_of: Column, field: str) -> Column:
        """The values that occur more than once."""
        values = F.array_sort(F.transform(all_of, lambda x: x["s"][field]))
        return let(values, lambda v: F.array_distinct(F.filter(v, lambda x, i: (i > 0) & (x == F.get(v, i - 1)))))

    def step(kept: Column, x: Column) -> Column:
        taken = F.exists(kept, lambda k: (k["s"]["start"] == x["s"]["start"]) | (k["s"]["end"] == x["s"]["end"]))
        return F.when(taken, kept).otherwise(F.array_append(kept, x))

    def split(c: Column) -> Column:
        shared = lambda x: F.array_contains(c["starts"], x["s"]["start"]) | F.array_contains(c["ends"], x["s"]["end"])
        free = F.filter(c["all"], lambda x: ~shared(x))
        kept = F.aggregate(F.filter(c["all"], shared), F.filter(c["all"], lambda x: F.lit(False)), step)
        return F.transform(F.array_sort(F.concat(free, kept)), lambda x: x["s"])

    def looked(all_of: Column) -> Column:
        return let(F.struct(all_of.alias("all"), twice(all_of, "start").alias("starts"), twice(all_of, "end").alias("ends")), split)

    return let(numbered, looked)


def span_windows(spans: Column, width: Column, limit: Column, ordered: bool = True) -> Column:
    """A window of about ``width`` characters around each span, clamped to ``[0, limit]``, sorted by start."""

    def window(s: Column) -> Column:
        half = half_even((width - (s["end"] - s["start"])) / 2)
        return let(
            half,
            lambda h: F.struct(
                F.greatest(s["start"] - h, F.lit(0)).cast("int").alias("start"), F.least(s["end"] + h, limit).cast("int").alias("end")
            ),
        )

    windows = F.transform(spans, window).cast(WINDOWS)
    return stable_sort_by(windows, "start") if ordered else windows


def window_cuts(windows: Column, limit: Column, dynamic: bool = True, compat: bool = False) -> Column:
    """The text ranges to keep, in order. Overlaps are emitted once.

    With ``dynamic`` the length saved by an overlap widens the windows that follow. ``compat`` lets the end
    of the emitted text move backwards when a window ends inside the one before it.
    """
    n = F.size(windows)

    def step(s: Column, w: Column) -> Column:
        widen = F.lit(dynamic) & (s["saved"] > 0)
        start = F.when(widen, F.greatest(half_even(w["start"] - s["saved"] / 2), F.lit(0))).otherwise(w["start"])
        end = F.when(widen, F.least(half_even(w["end"] + s["saved"] / 2), limit)).otherwise(w["end"])

        def place(p: Column) -> Column:
            overlaps = p["start"] < s["last"]
            left = n - (s["i"] + 1)
            gain = F.when(left > 0, half_even((s["last"] - p["start"]) / left)).otherwise(s["last"] - p["start"])
            saved = F.when(F.lit(dynamic) & overlaps, s["saved"] + gain).otherwise(s["saved"])
            stretched = F.when(p["end"] + saved < limit, p["end"] + half_even(saved / 2)).otherwise(limit)
            new_end = F.when(F.lit(dynamic) & overlaps & (left == 0), stretched).otherwise(p["end"])
            begin = F.when(overlaps, s["last"]).otherwise(p["start"])
            last = new_end if compat else F.greatest(s["last"], new_end)
            return F.struct(
                (s["i"] + 1).cast("int").alias("i"),
                last.cast("int").alias("last"),
                saved.cast("int").alias("saved"),
                F.array_append(s["out"], F.struct(begin.cast("int").alias("start"), new_end.cast("int").alias("end"))).alias("out"),
            )

        return let(F.struct(start.alias("start"), end.alias("end")), place)

    state = F.struct(F.lit(0).alias("i"), F.lit(-1).alias("last"), F.lit(0).alias("saved"), F.array().cast(WINDOWS).alias("out"))
    return F.aggregate(windows, state, step, lambda s: s["out"])


def shrink_to_spans(
    text: Column, spans: Column, budget: Column | int, threshold: float = SHRINK_THRESHOLD, dynamic: bool = True, compat: bool = False
) -> Column:
    """The windows around the kept spans, joined; empty without spans.

    ``compat`` also leaves out the last character of the text when a window reaches it.
    """
    budget = F.lit(budget) if isinstance(budget, int) else budget
    limit = (F.length(text) - 1 if compat else F.length(text)).cast("int")

    def join(kept: Column) -> Column:
        def cut(size: Column) -> Column:
            windows = span_windows(kept, size["width"], size["limit"])
            return let(windows, lambda w: window_cuts(w, size["limit"], dynamic, compat))

        cuts = let(F.struct(half_even(budget / F.size(kept)).alias("width"), limit.alias("limit")), cut)
        pieces = F.transform(cuts, lambda c: slice_of(text, c["start"], c["end"]))
        return F.when(F.size(kept) > 0, F.array_join(pieces, "")).otherwise(F.lit(""))

    return let(greedy_distinct(spans, threshold), join)


def shrink_documents(
    df: DataFrame,
    budget: int,
    rules: Mapping[str, Rule] | None = None,
    text: str = "text",
    spans: str = "spans",
    threshold: float = SHRINK_THRESHOLD,
    dynamic: bool = True,
    compat: bool = False,
) -> DataFrame:
    """Replace the text by its shrunk form; rules fill in entities without spans; nothing kept → truncation."""
    if rules is not None:
        df = rules_where_empty(df, rules, text, spans)
    shrunk = shrink_to_spans(F.col(text), F.col(spans), budget, threshold, dynamic, compat)
    return df.withColumn("__short", shrunk).withColumn(
        text, F.when(F.length("__short") > 0, F.col("__short")).otherwise(truncate(F.col(text), budget))
    ).drop("__short")
