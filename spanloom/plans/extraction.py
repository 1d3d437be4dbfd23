"""Documents to spans to a flat table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from ..constants import ENTITY_TYPES, FLAT_KEYS, SELECT_THRESHOLD
from ..functions.money import convert_money_columns
from ..functions.rules import Rule
from ..functions.text import clean_text
from ..operators.scoring import infer_spans
from ..operators.spans import flat_entity_table


def extract_to_table(
    documents: DataFrame,
    entities: Sequence[str] = tuple(ENTITY_TYPES),
    rules: Mapping[str, Rule] | None = None,
    make_scorer: Callable | None = None,
    text: str = "text",
    clean: bool = False,
    strategy: str | Callable = "all",
    threshold: float = SELECT_THRESHOLD,
    keys: Sequence[str] = tuple(FLAT_KEYS),
    money: Sequence[str] | None = None,
) -> DataFrame:
    """One row per document with its best span per entity; optionally cleaned texts and money as numbers.

    One stage: the scan, the extraction and the flat columns are all local to a row.
    """
    found = infer_spans(
        documents, rules, make_scorer, preprocess=clean_text if clean else None, strategy=strategy, threshold=threshold, text=text
    )
    flat = flat_entity_table(found, entities, keys, drop=(text, "spans"))
    return convert_money_columns(flat, money) if money else flat
