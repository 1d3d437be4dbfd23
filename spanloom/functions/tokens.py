"""Token offsets and position vectors. Offsets come from any tokenizer; characters are the default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let

OFFSETS = "array<struct<s:int,e:int>>"


def char_offsets(prompt: Column, content: Column, max_seq_len: int) -> Column:
    """Offsets of ``[CLS] prompt [SEP] content [SEP]`` with one token per character, padded to a length."""

    def chars(length: Column) -> Column:
        return F.when(
            length > 0,
            F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.struct(i.cast("int").alias("s"), (i + 1).cast("int").alias("e"))),
        ).otherwise(F.array().cast(OFFSETS))

    special = F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e")))
    room = F.greatest(F.lit(max_seq_len) - F.length(prompt) - 3, F.lit(0))
    used = F.least(F.length(content), room)
    padding = F.array_repeat(special[0], (room - used).cast("int"))
    return F.concat(special, chars(F.length(prompt)), special, chars(used), special, padding).cast(OFFSETS)


def _second_special(offsets: Column) -> Column:
    """1-based place of the first special token behind position 0; 0 without any."""
    return F.array_position(F.transform(offsets, lambda t, i: (i > 0) & (t["s"] == 0) & (t["e"] == 0)), True)


def _drift(offsets: Column, special: Column) -> Column:
    return F.when(special > 1, F.get(offsets, (special - 2).cast("int"))["e"] + 1).otherwise(F.lit(0)).cast("int")


def offset_drift(offsets: Column) -> Column:
    """End of the prompt plus one: the first special token after position 0 marks it."""
    return let(offsets, lambda o: let(_second_special(o), lambda at: _drift(o, at)))


def drift_offsets(offsets: Column) -> Column:
    """Shift the content tokens behind the prompt; prompt and special tokens stay."""

    def shift(o: Column, at: Column) -> Column:
        return let(
            F.struct(F.when(at > 0, at).otherwise(F.size(o) + 1).alias("at"), _drift(o, at).alias("by")),
            lambda d: F.transform(
                o,
                lambda t, i: F.when((i + 1 < d["at"]) | ((t["s"] == 0) & (t["e"] == 0)), t).otherwise(
                    F.struct((t["s"] + d["by"]).alias("s"), (t["e"] + d["by"]).alias("e"))
                ),
            ),
        )

    return let(offsets, lambda o: let(_second_special(o), lambda at: shift(o, at)))


def map_offset(position: Column, offsets: Column) -> Column:
    """Index of the token that covers a character, -1 when none does."""
    return (F.array_position(F.transform(offsets, lambda t: (t["s"] <= position) & (position < t["e"])), True) - 1).cast("int")


def align_offset(position: Column, offsets: Column) -> Column:
    """Like :func:`map_offset`, but one past the last token with both ends positive when none covers it."""
    last_real = F.array_max(F.transform(offsets, lambda t, i: F.when((t["s"] != 0) & (t["e"] != 0), i).otherwise(F.lit(0))))
    return let(map_offset(position, offsets), lambda at: F.when(at >= 0, at).otherwise(last_real + 1)).cast("int")


def char_index(offsets: Column) -> Column:
    """For each character the first token that covers it, or -1; NULL if tokens are not in the order of their text."""
    real = F.filter(F.transform(offsets, lambda t, i: F.struct(t["s"].alias("s"), t["e"].alias("e"), i.alias("i"))), lambda t: t["e"] > t["s"])

    def filled(r: Column) -> Column:
        def part(t: Column, k: Column) -> Column:
            before = F.coalesce(F.get(r, k - 1)["e"], F.lit(0))
            gap = F.array_repeat(F.lit(-1), F.greatest(t["s"] - before, F.lit(0)))
            return F.concat(gap, F.array_repeat(t["i"], F.greatest(t["e"] - F.greatest(t["s"], before), F.lit(0))))

        steps = F.zip_with(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 2, F.size(r)), lambda x, y: (y["s"] >= x["s"]) & (y["e"] >= x["e"]))
        return F.when(F.forall(steps, lambda x: x), F.flatten(F.transform(r, part)))

    return let(real, filled)


def marked(places: Column, length: int) -> Column:
    """A vector of ``length`` numbers, 1 at the places and 0 elsewhere; places outside it are left out."""
    zero, one = F.lit(0.0).cast("float"), F.lit(1.0).cast("float")
    inside = F.array_sort(F.array_distinct(F.filter(places, lambda p: (p >= 0) & (p < length))))

    def vector(ps: Column) -> Column:
        gaps = F.transform(ps, lambda p, k: F.concat(F.array_repeat(zero, (p - F.coalesce(F.get(ps, k - 1), F.lit(-1)) - 1).cast("int")), F.array(one)))
        rest = F.array_repeat(zero, (F.lit(length - 1) - F.coalesce(F.get(ps, F.size(ps) - 1), F.lit(-1))).cast("int"))
        return F.concat(F.flatten(gaps), rest)

    return let(inside, vector)


def position_vectors(result_list: Column, offsets: Column, length: int, lenient: bool = False) -> Column:
    """``struct(start_positions, end_positions)``: 0/1 vectors of ``length`` marking first and last tokens.

    ``lenient`` uses :func:`map_offset`, where a span outside the tokens marks the last position. The tokens are
    gone through once for all spans of a row.
    """

    def vectors(o: Column) -> Column:
        beyond = F.lit(length - 1) if lenient else F.array_max(F.transform(o["shifted"], lambda t, i: F.when((t["s"] != 0) & (t["e"] != 0), i).otherwise(F.lit(0)))) + 1

        def placed(x: Column) -> Column:
            def token(position: Column) -> Column:
                # A position before the text has no token; `get` gives NULL behind the end.
                at = F.when(x["index"].isNull(), map_offset(position, o["shifted"])).otherwise(F.coalesce(F.get(x["index"], position), F.lit(-1)))
                return let(at, lambda a: F.when(a < 0, x["beyond"]).otherwise(a)).cast("int")

            starts = F.transform(result_list, lambda r: token(r["start"] + o["drift"]))
            ends = F.transform(result_list, lambda r: token(r["end"] - 1 + o["drift"]))
            return F.struct(marked(starts, length).alias("start_positions"), marked(ends, length).alias("end_positions"))

        return let(F.struct(char_index(o["shifted"]).alias("index"), beyond.cast("int").alias("beyond")), placed)

    zeros = F.array_repeat(F.lit(0.0).cast("float"), length)
    nothing = F.struct(zeros.alias("start_positions"), zeros.alias("end_positions"))
    found = let(
        offsets, lambda o: let(F.struct(drift_offsets(o).alias("shifted"), offset_drift(o).alias("drift")), vectors)
    )
    return F.when(F.size(result_list) == 0, nothing).otherwise(found)


def padding_bucket(length: Column, options: Sequence[int], default: int) -> Column:
    """The smallest option that fits, else the default."""
    fitting = F.array_min(F.filter(F.array(*[F.lit(o) for o in options]), lambda o: o >= length))
    return F.coalesce(fitting, F.lit(default)).cast("int")


