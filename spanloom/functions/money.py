"""Chinese and Arabic money amounts to integers, as one regular grammar per amount.

An amount is up to four sections (兆, 億, 萬, units), each with up to four digits runs (千, 百, 十, ones).
The grammar is matched once; its groups are the sixteen cells of a positional number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ENTITY_TYPES, MISSING_TEXT
from .common import let

# Numerals by digit, and unit characters with their canonical form.
NUMERALS = {
    "0": "０〇零",
    "1": "１一壹",
    "2": "２二貳贰兩两",
    "3": "３三參叁叄",
    "4": "４四肆",
    "5": "５五伍",
    "6": "６六陸陆",
    "7": "７七柒",
    "8": "８八捌",
    "9": "９九玖",
}
UNITS = {"十": "拾", "百": "佰", "千": "仟", "萬": "万", "億": "亿", "兆": ""}
CURRENCY = "元"
APPROXIMATE = "餘"

_FROM = "".join(NUMERALS.values()) + "".join(UNITS.values())
_TO = "".join(d * len(v) for d, v in NUMERALS.items()) + "".join(u * len(v) for u, v in UNITS.items())

_SECTION = r"(\d*千)?(\d*百)?(\d*十)?(\d*)"
_GRAMMAR = rf"^(?:{_SECTION}兆)?(?:{_SECTION}億)?(?:{_SECTION}萬)?{_SECTION}{CURRENCY}?$"
_CELLS = ",".join(f"${n}" for n in range(1, 17))
_SMALL = [1000, 100, 10, 1]
_BIG = {"兆": 10**12, "億": 10**8, "萬": 10**4, "": 1}


def clean_amount(raw: Column) -> Column:
    """Drop the mark for "and a bit more" and everything that is neither letter nor digit."""
    return F.regexp_replace(F.replace(raw, F.lit(APPROXIMATE), F.lit("")), r"[^\p{L}\p{N}]", "")


def canonical_amount(text: Column) -> Column:
    """All digits ASCII, all units in their common traditional form."""
    return F.translate(text, _FROM, _TO)


def parse_amount(text: Column) -> Column:
    """The amount as ``BIGINT``, or NULL when the text is not an amount (:func:`clean_amount` not applied)."""

    def cell_value(cell: Column) -> Column:
        digits = F.regexp_replace(cell, r"\D", "")
        number = F.when(digits == "", F.lit(1)).otherwise(digits.try_cast("decimal(20,0)"))
        return F.when(cell == "", F.lit(0)).otherwise(number).cast("decimal(20,0)")

    def section(values: Column, index: int) -> Column:
        cells = [F.get(values, F.lit(index * 4 + n)) * F.lit(weight).cast("decimal(4,0)") for n, weight in enumerate(_SMALL)]
        return (cells[0] + cells[1] + cells[2] + cells[3]).try_cast("decimal(24,0)")

    def total(canonical: Column) -> Column:
        def weigh(values: Column) -> Column:
            sections = [section(values, n) for n in range(4)]
            parts = [s * F.lit(w).cast("decimal(13,0)") for s, w in zip(sections, _BIG.values())]
            empty_section = F.lit(False)
            for unit, amount in zip(_BIG, sections):
                if unit:
                    empty_section = empty_section | (F.contains(canonical, F.lit(unit)) & (amount == 0))
            return F.when(~empty_section, parts[0] + parts[1] + parts[2] + parts[3]).try_cast("bigint")

        cells = F.split(F.regexp_replace(canonical, _GRAMMAR, _CELLS), ",", -1)
        # Sums are exact in decimals; what does not fit into a BIGINT in the end is NULL.
        readable = canonical.rlike(_GRAMMAR) & canonical.rlike(r"[\d十百千]")
        return F.when(readable, let(F.transform(cells, cell_value), weigh))

    return let(canonical_amount(text), total)


def money_to_number(raw: Column, compat: bool = False) -> Column:
    """The amount behind a raw value, or NULL.

    A decimal point makes the value unreadable; with ``compat`` the point is dropped like any other mark.
    """
    value = parse_amount(clean_amount(raw))
    if compat:
        return value
    return F.when(~raw.rlike(r"[0-9０-９][.．][0-9０-９]"), value)


def is_missing(raw: Column) -> Column:
    return raw.isNull() | (raw == MISSING_TEXT)


def normalize_money(
    raw: Column, remain_outlier: bool = False, outlier: str = MISSING_TEXT, compat: bool = False
) -> Column:
    """The amount as text. Missing stays ``"nan"``; unreadable becomes ``outlier`` or stays (cleaned)."""
    failed = clean_amount(raw) if remain_outlier else F.lit(outlier)
    number = money_to_number(raw, compat).cast("string")
    return F.when(is_missing(raw), F.lit(MISSING_TEXT)).otherwise(F.coalesce(number, failed))


def fill_zeros(money: Column) -> Column:
    """Write out the zeros that speech leaves away (五萬六百元 → 五萬零六百元); NULL when units are out of order.

    The last character is the currency sign and is kept as 元.
    """
    # 零 has no counterpart and is deleted.
    body = F.translate(F.substring(money, F.lit(1), F.length(money) - 1), "万亿零", "萬億")

    def fill(text: Column) -> Column:
        in_order = ~text.rlike(
            "十[^萬億兆]*[十百千]|百[^萬億兆]*[百千]|千[^萬億兆]*千|萬.*[萬億兆]|億.*[億兆]|兆.*兆"
        )
        # Inside a section: a unit is followed by a lower one that is not the next.
        filled = F.regexp_replace(text, "千(?=[^十百千萬億兆]*十|[^十百千萬億兆]+(?:[萬億兆]|$))", "千零")
        filled = F.regexp_replace(filled, "百(?=[^十百千萬億兆]+(?:[萬億兆]|$))", "百零")
        # Between sections: always below 億 and 兆, below 萬 only when the thousands are missing.
        filled = F.regexp_replace(filled, "([億兆])(?=[^萬億兆])", "$1零")
        filled = F.regexp_replace(filled, "萬(?=[^千萬億兆]+$)", "萬零")
        return F.when(in_order, F.concat(filled, F.lit(CURRENCY)))

    return let(body, fill)


def convert_money_columns(df: DataFrame, entities: Sequence[str] = ENTITY_TYPES, **options) -> DataFrame:
    """Replace each entity column of a flat table by its amount."""
    return df.withColumns({e: normalize_money(F.col(f"`{e}`"), **options) for e in entities if e in df.columns})


def conversion_error_rate(df: DataFrame, columns: Mapping[str, Column] | Sequence[str], compat: bool = False) -> DataFrame:
    """Per column: values that could not be read, all values (missing included) and their ratio."""
    named = columns if isinstance(columns, Mapping) else {c: F.col(f"`{c}`") for c in columns}
    rows = F.array(*[F.struct(F.lit(n).alias("entity"), c.cast("string").alias("raw")) for n, c in named.items()])
    flat = df.select(F.inline(rows))
    failed = ~is_missing(F.col("raw")) & money_to_number(F.col("raw"), compat).isNull()
    return (
        flat.groupBy("entity")
        .agg(F.count_if(failed).alias("failed"), F.count(F.lit(1)).alias("total"))
        .withColumn("error_rate", F.round(F.col("failed") / F.col("total"), 6))
    )


def failed_amounts(df: DataFrame, column: str, compat: bool = False) -> DataFrame:
    """The distinct values that could not be read, with their frequency."""
    raw = F.col(f"`{column}`").cast("string")
    return (
        df.select(raw.alias("raw"))
        .where(~is_missing(F.col("raw")) & money_to_number(F.col("raw"), compat).isNull())
        .groupBy("raw")
        .agg(F.count(F.lit(1)).alias("n"))
    )
