"""Prompt texts of extraction and classification examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LABEL_SEPARATOR, PROMPT_OPTIONS, PROMPT_PREFIX, SUBJECT_LINK
from .common import let, seeded_hash, str_array


def relation_prompt(subject: Column, predicate: Column, lang: str = "ch") -> Column:
    """Chinese: subject, link, predicate. English: predicate, link, subject."""
    link = F.lit(SUBJECT_LINK[lang])
    return F.concat(subject, link, predicate) if lang == "ch" else F.concat(predicate, link, subject)


def shuffled_options(options: Sequence[str], seed: int | str, *keys: Column) -> Column:
    """The options in a repeatable random order per row."""
    keyed = F.transform(str_array(options), lambda o: F.struct(seeded_hash(seed, *keys, o).alias("h"), o.alias("o")))
    return F.transform(F.array_sort(keyed), lambda x: x["o"])


def classification_prompt(prefix: Column, options: Column) -> Column:
    return F.concat(prefix, F.lit("["), F.array_join(options, ","), F.lit("]"))


def last_position(text: Column, part: Column) -> Column:
    """0-based position of the last occurrence of ``part``, -1 when absent."""
    at = F.call_function("locate", F.reverse(part), F.reverse(text))
    return F.when(at == 0, F.lit(-1)).otherwise(F.length(text) - at + 1 - F.length(part)).cast("int")


def label_spans(prompt: Column, labels: Column) -> Column:
    """Each label as a span of the prompt, counted backwards from the content."""

    def span(label: Column) -> Column:
        start = last_position(prompt, label) - F.length(prompt) - 1
        return F.struct(label.alias("text"), start.cast("int").alias("start"), (start + F.length(label)).cast("int").alias("end"))

    return F.transform(labels, span)


def classification_example(
    content: Column,
    labels: Column,
    prefix: Column | str = PROMPT_PREFIX,
    options: Sequence[str] = tuple(PROMPT_OPTIONS),
    seed: int | str | None = None,
    keys: Sequence[Column] = (),
) -> Column:
    """``struct(content, result_list, prompt)``; options are shuffled per row when a seed is given."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    order = str_array(options) if seed is None else shuffled_options(options, seed, *keys)
    return let(
        classification_prompt(head, order),
        lambda p: F.struct(content.alias("content"), label_spans(p, labels).alias("result_list"), p.alias("prompt")),
    )


def split_class_labels(label: Column, separator: str = LABEL_SEPARATOR) -> Column:
    """``struct(entity, classes)`` of a label such as ``food##good``; ``classes`` is NULL without any."""
    return let(
        F.split(label, rf"\Q{separator}\E", -1),
        lambda p: F.struct(
            p[0].alias("entity"),
            F.when(F.size(p) > 1, F.slice(p, 2, F.size(p))).alias("classes"),
        ),
    )


def unify_prompt(prompt: Column) -> Column:
    """Sort and de-duplicate the options in the brackets that end a prompt."""
    options = F.regexp_extract(prompt, r"\[(.*?)\]$", 1)
    sorted_options = F.array_join(F.array_sort(F.array_distinct(F.split(options, ",", -1))), ",")
    # The prefix ends at the first bracket after the first character.
    at = F.call_function("locate", F.lit("["), prompt, F.lit(2))
    head = F.when(at > 0, F.substring(prompt, F.lit(1), at - 1)).otherwise(F.substring(prompt, F.lit(1), F.length(prompt) - 1))
    return F.when(prompt.rlike(r"\[.*?\]$"), F.concat(head, F.lit("["), sorted_options, F.lit("]"))).otherwise(prompt)


def relation_type(prompt: Column, lang: str = "ch") -> Column:
    """The predicate of a prompt: what follows the last link (Chinese) or precedes the first (English)."""
    part = F.substring_index(prompt, SUBJECT_LINK[lang], -1 if lang == "ch" else 1)
    return unify_prompt(part)


def shared_relation(a: Column, b: Column, lang: str = "ch") -> Column:
    """The predicate two prompts share, or the empty string.

    It is their longest common tail when that begins with the link (Chinese), or their longest common
    head when that ends with the link (English), without the link.
    """
    link = SUBJECT_LINK[lang]
    lengths = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    if lang == "ch":
        same = F.array_max(F.filter(lengths, lambda n: F.right(a, n) == F.right(b, n)))
        common = F.right(a, same)
        return F.when(F.startswith(common, F.lit(link)), F.substring(common, F.lit(len(link) + 1), F.length(common))).otherwise(F.lit(""))
    same = F.array_max(F.filter(lengths, lambda n: F.left(a, n) == F.left(b, n)))
    common = F.left(a, same)
    link = link.rstrip(" ")
    return F.when(F.endswith(common, F.lit(link)), F.left(common, F.length(common) - len(link))).otherwise(F.lit(""))


def group_relations(pairs: Column, lang: str = "ch") -> Column:
    """Group the ``(prompt, value)`` pairs of one document by shared predicate.

    In order, a prompt that no earlier prompt has claimed claims every later one it shares a predicate
    with; without any it stands under its own predicate. Result: ``ARRAY<STRUCT<type, value>>``.
    """
    out_type = "array<struct<type:string,value:string>>"
    state = F.struct(F.lit(0).alias("i"), F.array().cast("array<string>").alias("claimed"), F.array().cast(out_type).alias("out"))

    def entry(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("type"), value.cast("string").alias("value"))

    def step(s: Column, x: Column) -> Column:
        later = F.slice(pairs, s["i"] + 2, F.size(pairs))
        shared = F.filter(
            F.transform(later, lambda y: F.struct(shared_relation(x["prompt"], y["prompt"], lang).alias("kind"), y.alias("y"))),
            lambda m: m["kind"] != "",
        )

        def claim(matches: Column) -> Column:
            alone = F.array(entry(relation_type(x["prompt"], lang), x["value"]))
            group = F.concat(
                F.array(entry(unify_prompt(F.get(matches, F.lit(0))["kind"]), x["value"])),
                F.transform(matches, lambda m: entry(unify_prompt(m["kind"]), m["y"]["value"])),
            )
            return F.struct(
                (s["i"] + 1).alias("i"),
                F.concat(s["claimed"], F.array(x["prompt"]), F.transform(matches, lambda m: m["y"]["prompt"])).alias("claimed"),
                F.concat(s["out"], F.when(F.size(matches) == 0, alone).otherwise(group)).alias("out"),
            )

        skipped = F.struct((s["i"] + 1).alias("i"), s["claimed"].alias("claimed"), s["out"].alias("out"))
        return F.when(F.array_contains(s["claimed"], x["prompt"]), skipped).otherwise(let(shared, claim))

    return F.aggregate(pairs, state, step, lambda s: s["out"])
