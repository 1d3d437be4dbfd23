"""Small column helpers used by the other function modules."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.transform(F.array(value), body)[0]


def settle(df: DataFrame, *columns: str) -> DataFrame:
    """The same frame with some computed columns passed through a generator of one row.

    A filter on them then stays above, where it would else be pushed down and compute them a second time.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in others], F.inline(F.array(F.struct(*columns)))).select(*[F.col(f"`{c}`") for c in df.columns])


def str_array(values: Iterable[str]) -> Column:
    """A literal ``ARRAY<STRING>``, also for no values."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def slice_of(text: Column, start: Column, end: Column) -> Column:
    """Characters ``[start, end)`` of ``text``; empty when the range is empty."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def half_even(value: Column) -> Column:
    """Round a double to an integer, ties to even."""
    return F.bround(value.cast("double"), 0).cast("int")


def seeded_hash(seed: int | str, *keys: Column) -> Column:
    """32 hex digits that order rows in a repeatable random order."""
    parts: list[Column] = [F.lit(str(seed))]
    for key in keys:
        parts += [F.lit(":"), key.cast("string")]
    # Never NULL, so that joins and filters on it need no further check.
    return F.coalesce(F.md5(F.concat(*parts).cast("binary")), F.lit(""))


def hash_mod(seed: int | str, size: Column, *keys: Column) -> Column:
    """A repeatable random number in ``[0, size)``, from the first 15 hex digits of :func:`seeded_hash`."""
    number = F.conv(F.substring(seeded_hash(seed, *keys), 1, 15), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(number, size.cast("bigint")), F.lit(0).cast("bigint"))


def stable_sort_by(values: Column, *fields: str) -> Column:
    """Sort an array of structs by some fields; equal elements keep their order."""
    keyed = F.transform(values, lambda x, i: F.struct(*[x[f].alias(f"k{n}") for n, f in enumerate(fields)], i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda k: k["x"])


#: Elements that :func:`running` folds before it starts a new output array.
RUN_GROUP = 256


def running(values: Column, state: Column, step: Callable[[Column, Column], Column], out_type: str) -> Column:
    """``struct(state, out)``: ``step(state, x)`` gives ``struct(state, out)`` for each element, and the outs are listed.

    The outs are gathered in groups, since appending copies an array each time.
    """

    def fold(start: Column, group: Column) -> Column:
        empty = F.array().cast(f"array<{out_type}>")

        def one(s: Column, x: Column) -> Column:
            return let(step(s["state"], x), lambda r: F.struct(r["state"].alias("state"), F.array_append(s["out"], r["out"]).alias("out")))

        return F.aggregate(group, F.struct(start.alias("state"), empty.alias("out")), one)

    def folded(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v), F.lit(RUN_GROUP))
        nothing = F.struct(state.alias("state"), F.array().cast(f"array<array<{out_type}>>").alias("out"))

        def group(s: Column, at: Column) -> Column:
            return let(fold(s["state"], F.slice(v, at, RUN_GROUP)), lambda r: F.struct(r["state"].alias("state"), F.array_append(s["out"], r["out"]).alias("out")))

        return F.when(F.size(v) == 0, nothing).otherwise(F.aggregate(starts, nothing, group))

    return let(let(values, folded), lambda r: F.struct(r["state"].alias("state"), F.flatten(r["out"]).alias("out")))
