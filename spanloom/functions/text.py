"""Text cleaning, offset bookkeeping and cutting of long texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PAIR_SEPARATOR, SPECIAL_CHARS, SPECIAL_PAIRS
from .common import let

# The characters that Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts longer than this are addressed through blocks, so that reading many places of one
# text costs a block each and not a walk from its beginning.
BLOCK_CHARS = 4096


def check_single_chars(specials: Sequence[str]) -> None:
    if any(len(s) != 1 for s in specials):
        raise ValueError("Each special token must be exactly one character.")


def drop_chars(text: Column, specials: Sequence[str] = SPECIAL_CHARS) -> Column:
    return F.translate(text, "".join(specials), "")


def drop_pairs(text: Column, pairs: Sequence[str] = SPECIAL_PAIRS) -> Column:
    for pair in pairs:
        text = F.replace(text, F.lit(pair), F.lit(""))
    return text


def clean_text(text: Column, specials: Sequence[str] = SPECIAL_CHARS, pairs: Sequence[str] = SPECIAL_PAIRS) -> Column:
    """Remove the special characters, then the escaped line break spelled with two characters."""
    return drop_pairs(drop_chars(text, specials), pairs)


def has_fullwidth_space(text: Column) -> Column:
    return F.contains(text, F.lit("\u3000"))


def strip_text(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def stripped_prefix(text: Column) -> Column:
    """How many characters :func:`strip_text` removes at the front."""
    return (F.length(text) - F.length(F.ltrim(text, F.lit(WHITESPACE)))).cast("int")


def split_pair(text: Column, separator: str = PAIR_SEPARATOR) -> Column:
    """``struct(text_a, text_b)``: the last piece is ``text_b``, everything before it is ``text_a``."""
    return let(
        F.split(text, rf"\Q{separator}\E", -1),
        lambda p: F.when(F.size(p) == 1, F.struct(p[0].alias("text_a"), F.lit("").alias("text_b"))).otherwise(
            F.struct(
                F.array_join(F.slice(p, 1, F.size(p) - 1), "").alias("text_a"),
                F.element_at(p, -1).alias("text_b"),
            )
        ),
    )


def truncate(text: Column, budget: Column | int) -> Column:
    return F.substring(text, 1, budget)


def text_blocks(text: Column, size: int = BLOCK_CHARS) -> Column:
    """The text as consecutive pieces of ``size`` characters, cut in one pass."""
    return F.when(F.length(text) <= size, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))


def read_blocks(blocks: Column, start: Column, end: Column, size: int = BLOCK_CHARS) -> Column:
    """Characters ``[start, end)`` of a text held as blocks; touches only the blocks concerned."""
    first = F.floor(start / size).cast("int")
    last = F.floor((F.greatest(end, start + 1) - 1) / size).cast("int")
    window = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.substring(window, start - first * size + 1, F.greatest(end - start, F.lit(0)))


def counting_before(text: Column, specials: Sequence[str], body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """Run ``body(count_before)``, where ``count_before(x)`` counts special characters before position ``x``.

    The counts of whole blocks are summed once, so each position costs one block.
    """

    def count(piece: Column) -> Column:
        return F.length(piece) - F.length(drop_chars(piece, specials))

    def with_blocks(blocks: Column) -> Column:
        sums = F.aggregate(
            blocks,
            F.array(F.lit(0)),
            lambda acc, block: F.array_append(acc, F.element_at(acc, -1) + count(block)),
        )

        def with_sums(s: Column) -> Column:
            def count_before(x: Column) -> Column:
                at = F.least(F.floor(x / BLOCK_CHARS).cast("int"), F.size(blocks) - 1)
                head = F.substring(F.get(blocks, at), F.lit(1), x - at * BLOCK_CHARS)
                return (F.get(s, at) + count(head)).cast("int")

            return body(count_before)

        return let(sums, with_sums)

    return let(text_blocks(text), with_blocks)
