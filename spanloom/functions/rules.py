"""Rule extraction: regular expressions with code-point offsets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DEFAULT_SPAN_TEXT, RULE_PROBABILITY
from ..schemas import SPANS
from .common import let


@dataclass(frozen=True)
class Rule:
    """Try ``first``; if it finds nothing try ``second``; if that finds nothing use the default span.

    A pattern must not match the empty string, as offsets are counted between matches.
    """

    first: str
    second: str | None = None
    only_first_match: bool = False
    default_text: str | None = None

    def __post_init__(self) -> None:
        for pattern in (self.first, self.second):
            if pattern is not None and _matches_nothing(pattern):
                raise ValueError(f"The pattern {pattern!r} matches the empty string.")


def _matches_nothing(pattern: str) -> bool:
    try:
        return re.match(pattern, "") is not None
    except re.error:  # a form that only the engine knows
        return False


# Trigger phrases of the three rule families. "[^\n]" stands for any character but a line break.
_MARKS = ["%", "分之", "％", "/"]
_CAUSES = ["過失", "責任", "肇事"]
AGE_RULE = Rule(
    first="[^\n][^65]歲|出生|年[^\n]{0,5}[^發|^產]生|年次|年紀",
    second="歲|退休|學生|小學|國中|高中|大學|研究所|畢業|未成年|原告[^\n]{0,15}年\\}",
    default_text=DEFAULT_SPAN_TEXT,
)
LIABILITY_RULE = Rule(
    first="|".join(f"{m}[^\n]{{0,20}}{c}|{c}[^\n]{{0,20}}{m}" for m in _MARKS for c in _CAUSES),
    second="比例|%|肇事|責任|過失|％|[^部]分之",
    default_text=DEFAULT_SPAN_TEXT,
)
INJURY_RULE = Rule(
    first="受有[^\n]{0,100}傷害|受有[^\n]{0,100}傷勢",
    second="受有|傷",
    only_first_match=True,
    default_text=DEFAULT_SPAN_TEXT,
)


def default_rules(entities: Sequence[str]) -> dict[str, Rule]:
    """The three rule families bound to the entity names of a schema, in order."""
    return dict(zip(entities, (AGE_RULE, LIABILITY_RULE, INJURY_RULE)))


def pieces_between(text: Column, pattern: str, limit: int = -1) -> Column:
    """What lies between the matches.

    ``split`` compiles its pattern for every row, ``regexp_replace`` once; so matches become a character
    that splits without a pattern, except in a text that has this character.
    """
    mark = "\0"
    return F.when(F.contains(text, F.lit(mark)), F.split(text, pattern, limit)).otherwise(
        F.split(F.regexp_replace(text, pattern, mark), mark, limit)
    )


#: Matches that are folded one after the other.
GROUP = 256


def find_all(text: Column, pattern: str) -> Column:
    """All matches as ``ARRAY<STRUCT<start, end, text>>``; the pattern must not match the empty string.

    A match starts after the pieces and matches in front of it, so offsets are running sums of lengths
    and count code points. They are summed within groups of matches and then over the groups, because
    appending copies an array each time.
    """
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def fold(group: Column) -> Column:
        return F.aggregate(
            group,
            F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + x["len"]).alias("at"),
                F.array_append(
                    s["out"],
                    F.struct(
                        (s["at"] + x["gap"]).alias("start"),
                        (s["at"] + x["gap"] + x["len"]).alias("end"),
                        x["text"].alias("text"),
                    ),
                ).alias("out"),
            ),
        )

    def grouped(matches: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / GROUP).cast("int"))
        return let(F.transform(numbers, lambda n: fold(F.slice(matches, n * GROUP + 1, GROUP))), placed)

    def placed(groups: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        bases = F.aggregate(groups, start, lambda s, g: F.struct((s["at"] + g["at"]).alias("at"), F.array_append(s["out"], s["at"]).alias("out")), lambda s: s["out"])
        moved = lambda g, b: F.transform(g["out"], lambda x: F.struct((x["start"] + b).alias("start"), (x["end"] + b).alias("end"), x["text"].alias("text")))
        return F.flatten(F.zip_with(groups, bases, moved))

    def spans(found: Column) -> Column:
        with_gap = F.zip_with(
            F.slice(found["gaps"], 1, F.size(found["hits"])),
            found["hits"],
            lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("text"), F.length(h).alias("len")),
        )
        return let(with_gap, grouped)

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(
        hits,
        lambda h: F.when(F.size(h) == 0, none).otherwise(
            let(F.struct(h.alias("hits"), pieces_between(text, pattern).alias("gaps")), spans)
        ),
    )


def find_first(text: Column, pattern: str) -> Column:
    """Like :func:`find_all`, first match only."""
    hit = F.regexp_substr(text, F.lit(pattern))
    return let(
        hit,
        lambda h: F.when(h.isNull(), F.array().cast("array<struct<start:int,end:int,text:string>>")).otherwise(
            let(
                F.length(pieces_between(text, pattern, 2)[0]),
                lambda n: F.array(F.struct(n.alias("start"), (n + F.length(h)).alias("end"), h.alias("text"))),
            )
        ),
    )


def apply_rule(text: Column, rule: Rule) -> Column:
    """The matches of one rule, after its fallback."""
    found = find_first(text, rule.first) if rule.only_first_match else find_all(text, rule.first)

    def or_default(hits: Column) -> Column:
        if rule.default_text is None:
            return hits
        default = F.array(F.struct(F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit(rule.default_text).alias("text")))
        return F.when(F.size(hits) > 0, hits).otherwise(default)

    if rule.second is None:
        return let(found, or_default)
    return let(found, lambda h: F.when(F.size(h) > 0, h).otherwise(let(find_all(text, rule.second), or_default)))


def stand_in_probability(span: Column) -> Column:
    """A repeatable probability from position and length, for data without a model."""
    return (F.pmod(span["start"] * 7 + (span["end"] - span["start"]) * 13, F.lit(100)) / 100).cast("double")


def constant_probability(span: Column) -> Column:
    return F.lit(RULE_PROBABILITY)


def as_entity_spans(hits: Column, entity: str, probability=constant_probability) -> Column:
    """Matches of one rule as spans of ``entity``, numbered from 0."""
    return F.transform(
        hits,
        lambda x, i: F.struct(
            F.lit(entity).alias("entity"),
            i.cast("int").alias("ord"),
            x["start"].cast("int").alias("start"),
            x["end"].cast("int").alias("end"),
            x["text"].alias("text"),
            probability(x).cast("double").alias("probability"),
        ),
    )


def rule_spans(text: Column, rules: Mapping[str, Rule], probability=constant_probability) -> Column:
    """The spans of every rule, in the order of the rules."""
    parts = [as_entity_spans(apply_rule(text, rule), entity, probability) for entity, rule in rules.items()]
    return F.concat(*parts).cast(SPANS)
