"""Selecting, filling, flattening and collecting spans.

Documents carry their spans in an array column (``schemas.SPANS``), so everything that concerns one
document is row-local and never shuffles. The same operators for spans in a long table aggregate with
partial (map-side) aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    EXPORT_THRESHOLD,
    FLAT_KEYS,
    FLAT_NAMES,
    MISSING_POSITION,
    MISSING_PROBABILITY,
    MISSING_TEXT,
    SELECT_THRESHOLD,
)
from ..functions.common import let
from ..functions.rules import Rule, apply_rule, as_entity_spans, constant_probability, rule_spans
from ..schemas import SPANS


def extract_spans(
    df: DataFrame, rules: Mapping[str, Rule], text: str = "text", out: str = "spans", probability=constant_probability
) -> DataFrame:
    """Add the spans found by the rules."""
    return df.withColumn(out, rule_spans(F.col(text), rules, probability))


def of_entity(spans: Column, entity: str | Column) -> Column:
    return F.filter(spans, lambda s: s["entity"] == entity)


def best_span(spans: Column) -> Column:
    """The span of highest probability; the first of equals; NULL for an empty array."""
    return let(
        spans,
        lambda c: F.aggregate(
            F.slice(c, 2, F.greatest(F.size(c), F.lit(1))),
            F.get(c, F.lit(0)),
            lambda best, s: F.when(s["probability"] > best["probability"], s).otherwise(best),
        ),
    )


def select_all(spans: Column, threshold: float = SELECT_THRESHOLD) -> Column:
    return spans


def select_threshold(spans: Column, threshold: float = SELECT_THRESHOLD, inclusive: bool = False) -> Column:
    return F.filter(spans, lambda s: s["probability"] >= threshold if inclusive else s["probability"] > threshold)


def select_max(spans: Column, threshold: float = SELECT_THRESHOLD) -> Column:
    """One span per entity present."""
    entities = F.array_distinct(F.transform(spans, lambda s: s["entity"]))
    return F.transform(entities, lambda e: best_span(of_entity(spans, e)))


# Strategies by name; users may add their own ``(spans, threshold) -> spans``.
STRATEGIES: dict[str, Callable[[Column, float], Column]] = {
    "all": select_all,
    "threshold": select_threshold,
    "max": select_max,
}


def select_spans(df: DataFrame, strategy: str | Callable = "all", threshold: float = SELECT_THRESHOLD, spans: str = "spans") -> DataFrame:
    """Apply a selection strategy, given by name or as a function."""
    if isinstance(strategy, str):
        if strategy not in STRATEGIES:
            raise ValueError(f"Unknown strategy {strategy!r}; known: {sorted(STRATEGIES)}.")
        strategy = STRATEGIES[strategy]
    return df.withColumn(spans, strategy(F.col(spans), threshold))


def fill_missing(df: DataFrame, entities: Sequence[str], text: str = MISSING_TEXT, spans: str = "spans") -> DataFrame:
    """Give every entity without a span one default span."""

    def default(entity: str) -> Column:
        return F.struct(
            F.lit(entity).alias("entity"),
            F.lit(0).alias("ord"),
            F.lit(MISSING_POSITION).alias("start"),
            F.lit(MISSING_POSITION).alias("end"),
            F.lit(text).alias("text"),
            F.lit(MISSING_PROBABILITY).alias("probability"),
        )

    c = F.col(spans)
    defaults = F.array(*[default(e) for e in entities]).cast(SPANS)
    present = F.transform(c, lambda s: s["entity"])
    missing = let(present, lambda p: F.filter(defaults, lambda d: ~F.array_contains(p, d["entity"])))
    return df.withColumn(spans, F.concat(c, missing))


def rules_where_empty(df: DataFrame, rules: Mapping[str, Rule], text: str = "text", spans: str = "spans") -> DataFrame:
    """Add rule spans for the entities a model returned nothing for; they stand after the model's spans."""
    c = F.col(spans)
    present = F.transform(c, lambda s: s["entity"])
    added = [
        F.when(F.array_contains(present, F.lit(entity)), F.array().cast(SPANS)).otherwise(
            as_entity_spans(apply_rule(F.col(text), rule), entity).cast(SPANS)
        )
        for entity, rule in rules.items()
    ]
    return df.withColumn(spans, F.concat(c, *added))


def flat_entity_table(
    df: DataFrame,
    entities: Sequence[str],
    keys: Sequence[str] = tuple(FLAT_KEYS),
    drop: Sequence[str] = ("text", "spans"),
    spans: str = "spans",
    missing: str = MISSING_TEXT,
) -> DataFrame:
    """One row per document and one column per entity and key, from the best span of each entity.

    ``text`` becomes a column named after the entity, other keys ``uie_result_..._for_<entity>``. Row-local:
    the entity list is known, so no pivot and no shuffle are needed.
    """
    defaults = {"text": F.lit(missing), "start": F.lit(MISSING_POSITION), "end": F.lit(MISSING_POSITION), "probability": F.lit(MISSING_PROBABILITY)}
    best = {e: f"__best_{n}" for n, e in enumerate(entities)}
    df = df.withColumns({name: best_span(of_entity(F.col(spans), e)) for e, name in best.items()})
    columns = {}
    for entity, name in best.items():
        for key in keys:
            column = entity if key == "text" else f"{FLAT_NAMES[key]}_for_{entity}"
            columns[column] = F.coalesce(F.col(name)[key], defaults[key])
    return df.withColumns(columns).drop(*best.values(), *drop)


def span_rows(df: DataFrame, keys: Sequence[str], spans: str = "spans", threshold: float | None = None, inclusive: bool = True) -> DataFrame:
    """One row per span; the threshold of the annotation export is inclusive (default 0.5 there)."""
    c = F.col(spans)
    if threshold is not None:
        c = select_threshold(c, threshold, inclusive)
    # Not the bare column: Spark would infer a filter on its size, push it down and find the spans again for it.
    return df.select(*keys, F.inline(F.transform(c, lambda s: s)))


def export_rows(df: DataFrame, keys: Sequence[str], spans: str = "spans") -> DataFrame:
    return span_rows(df, keys, spans, EXPORT_THRESHOLD, True)


def top_span(long_spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best span per (document, entity) of a long table; partial aggregation keeps hot keys small."""
    value = F.struct(*[F.col(c) for c in long_spans.columns if c not in keys])
    rank = F.struct(F.col("probability"), (-F.col("ord")).alias("o"))
    return long_spans.groupBy(*keys).agg(F.max_by(value, rank).alias("v")).select(*keys, "v.*")


def collect_by_label(spans: Column, label: str = "entity") -> Column:
    """``ARRAY<STRUCT<label, result_list>>``: the spans of a document grouped by label, ordered by start."""
    labels = F.array_distinct(F.transform(spans, lambda s: s[label]))

    def group(name: Column) -> Column:
        mine = F.transform(
            F.filter(spans, lambda s: s[label] == name),
            lambda s, i: F.struct(s["start"].alias("start"), i.alias("i"), s["end"].alias("end"), s["text"].alias("text")),
        )
        ordered = F.transform(F.array_sort(mine), lambda s: F.struct(s["text"].alias("text"), s["start"].alias("start"), s["end"].alias("end")))
        return F.struct(name.alias("label"), ordered.alias("result_list"))

    return F.transform(labels, group)


def keep_keys(spans: Column, keys: Sequence[str]) -> Column:
    """Only the chosen fields of each span."""
    return F.transform(spans, lambda s: F.struct(*[s[k].alias(k) for k in keys]))


def as_entity_map(spans: Column, keys: Sequence[str] = ("text", "start", "end", "probability")) -> Column:
    """The nested layout of saved results: a one-element array of entity → spans."""
    grouped = F.transform(
        F.array_distinct(F.transform(spans, lambda s: s["entity"])),
        lambda e: F.struct(e.alias("key"), keep_keys(of_entity(spans, e), keys).alias("value")),
    )
    return F.array(F.map_from_entries(grouped))


def from_entity_map(results: Column) -> Column:
    """Spans of the nested layout, in the order of its entities."""
    entries = let(
        F.get(results, F.lit(0)),
        lambda m: F.transform(
            F.map_entries(m),
            lambda kv: F.transform(
                kv["value"],
                lambda s, i: F.struct(
                    kv["key"].alias("entity"), i.cast("int").alias("ord"), s["start"].alias("start"),
                    s["end"].alias("end"), s["text"].alias("text"), s["probability"].alias("probability"),
                ),
            ),
        ),
    )
    return F.coalesce(F.flatten(entries), F.array().cast(SPANS)).cast(SPANS)
