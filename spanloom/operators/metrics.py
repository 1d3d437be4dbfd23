"""Span and multi-label metrics. Everything per row is computed in place; only counters are aggregated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LABEL_THRESHOLD
from ..functions.common import let
from ..session import durable

DIGITS = 6
TOTAL = "total"


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 when ``b`` is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def precision_recall_f1(correct: Column, predicted: Column, gold: Column) -> dict[str, Column]:
    p, r = ratio(correct, predicted), ratio(correct, gold)
    return {
        "precision": F.round(p, DIGITS),
        "recall": F.round(r, DIGITS),
        "f1": F.round(ratio(2 * correct, predicted + gold), DIGITS),
    }


def span_counts(gold: Column, predicted: Column) -> Column:
    """``struct(correct, predicted, gold)`` of one example, from arrays of ``struct(start, end)``-like spans."""

    def ends(spans: Column) -> Column:
        return F.array_distinct(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"))))

    return let(
        F.struct(ends(gold).alias("g"), ends(predicted).alias("p")),
        lambda x: F.struct(
            F.size(F.array_intersect(x["g"], x["p"])).cast("bigint").alias("correct"),
            F.size(x["p"]).cast("bigint").alias("predicted"),
            F.size(x["g"]).cast("bigint").alias("gold"),
        ),
    )


def span_metrics(examples: DataFrame, gold: str = "gold", predicted: str = "predicted", by: str | None = None) -> DataFrame:
    """Micro precision, recall and F1 over all examples; with ``by`` also per class, plus a total row."""
    counted = examples.select(*([by] if by else []), span_counts(F.col(gold), F.col(predicted)).alias("c"))
    return _score(counted.select(*([by] if by else []), "c.*"), by)


def _score(counts: DataFrame, by: str | None) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("correct", "predicted", "gold")]
    if by is None:
        out = counts.agg(*sums)
    else:
        out = counts.rollup(by).agg(*sums, F.grouping(by).alias("__g")).withColumn(by, F.when(F.col("__g") == 1, F.lit(TOTAL)).otherwise(F.col(by))).drop("__g")
    return out.withColumns(precision_recall_f1(F.col("correct"), F.col("predicted"), F.col("gold")))


def span_metrics_long(gold: DataFrame, predicted: DataFrame, keys: Sequence[str], by: str | None = None) -> DataFrame:
    """The same for gold and predicted spans in separate long tables, keyed by e.g. (document, chunk, prompt, start, end).

    A union and an aggregation instead of a full join: equal spans meet, and hot keys combine early.
    """
    flags = gold.select(*keys, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(predicted.select(*keys, F.lit(0).alias("g"), F.lit(1).alias("p")))
    spans = flags.groupBy(*keys).agg(F.max("g").alias("gold"), F.max("p").alias("predicted"))
    return _score(spans.select(*([by] if by else []), (F.col("gold") * F.col("predicted")).alias("correct"), "predicted", "gold"), by)


def distinguishing_prefix(entities: Sequence[str]) -> int:
    """Length of the shortest name; an error when names are not distinct within it."""
    n = min(len(e) for e in entities)
    if len({e[:n] for e in entities}) != len(entities):
        raise ValueError(f"Entity names must differ within their first {n} characters.")
    return n


def prefix_check(names: DataFrame, name: str) -> DataFrame:
    """The same for a column of names: shortest length, distinct names and distinct prefixes."""
    distinct = names.select(F.col(name).alias("n")).distinct()
    shortest = distinct.agg(F.min(F.length("n"))).first()[0]
    return (
        distinct.agg(
            F.lit(shortest).cast("int").alias("prefix_len"),
            F.count("n").alias("names"),
            F.countDistinct(F.left("n", F.lit(shortest))).alias("prefixes"),
        )
        .withColumn("distinguishable", F.col("names") == F.col("prefixes"))
    )


def prefix_entity(prompt: Column, entities: Sequence[str]) -> Column:
    """The entity a prompt belongs to, by its distinguishing prefix."""
    n = distinguishing_prefix(entities)
    out = F.lit(None).cast("string")
    for e in entities:
        out = F.when(F.left(prompt, F.lit(n)) == e[:n], F.lit(e)).otherwise(out)
    return out


def _label_cells(truth: str, predicted: str) -> Column:
    """Per row one cell per label that is true or predicted, and a cell -1 that says whether the row is exact."""
    pairs = F.arrays_zip(F.col(truth).alias("y"), F.col(predicted).alias("p"))
    cells = F.transform(
        pairs,
        lambda x, i: F.struct(
            i.cast("int").alias("label"),
            ((x["y"] == 1) & (x["p"] == 1)).cast("bigint").alias("tp"),
            ((x["y"] != 1) & (x["p"] == 1)).cast("bigint").alias("fp"),
            ((x["y"] == 1) & (x["p"] != 1)).cast("bigint").alias("fn"),
        ),
    )
    active = F.filter(cells, lambda c: c["tp"] + c["fp"] + c["fn"] > 0)
    exact = F.size(F.filter(active, lambda c: c["fp"] + c["fn"] > 0)) == 0
    row = F.struct(F.lit(-1).alias("label"), exact.cast("bigint").alias("tp"), (~exact).cast("bigint").alias("fp"), F.lit(0).cast("bigint").alias("fn"))
    return F.concat(F.array(row), active)


def predictions(logits: Column, threshold: float = LABEL_THRESHOLD) -> Column:
    """0/1 vector of the labels whose probability is above the threshold (strict)."""
    from ..functions.labels import sigmoid

    return F.transform(logits, lambda x: F.when(sigmoid(x.cast("double")) > threshold, F.lit(1)).otherwise(F.lit(0)))


def label_counts(df: DataFrame, truth: str = "labels", predicted: str = "predicted") -> DataFrame:
    """``label, tp, fp, fn``; row -1 counts exact and inexact rows."""
    return (
        df.select(F.inline(_label_cells(truth, predicted)))
        .groupBy("label")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )


def multilabel_metrics(df: DataFrame, n_labels: int, truth: str = "labels", predicted: str = "predicted") -> DataFrame:
    """One row: micro and macro F1, subset accuracy, micro precision and recall."""
    counts = label_counts(df, truth, predicted)
    is_label = F.col("label") >= 0

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.when(is_label, F.col(c))), F.lit(0))

    f1 = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    sums = counts.agg(
        total("tp").alias("tp"), total("fp").alias("fp"), total("fn").alias("fn"),
        F.coalesce(F.sum(F.when(is_label, f1)), F.lit(0.0)).alias("f1_sum"),
        F.coalesce(F.sum(F.when(~is_label, F.col("tp"))), F.lit(0)).alias("exact"),
        F.coalesce(F.sum(F.when(~is_label, F.col("tp") + F.col("fp"))), F.lit(0)).alias("n_rows"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        F.round(ratio(2 * tp, 2 * tp + fp + fn), DIGITS).alias("micro_f1"),
        F.round(F.col("f1_sum") / n_labels, DIGITS).alias("macro_f1"),
        F.round(ratio(F.col("exact"), F.col("n_rows")), DIGITS).alias("accuracy"),
        F.round(ratio(tp, tp + fp), DIGITS).alias("precision"),
        F.round(ratio(tp, tp + fn), DIGITS).alias("recall"),
    )


def label_report(df: DataFrame, labels: Sequence[str], truth: str = "labels", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per label, plus micro, macro and weighted averages."""
    vocabulary = df.sparkSession.createDataFrame([(i, l) for i, l in enumerate(labels)], "label int, name string")
    # As many rows as the vocabulary, which is an argument; written out because the averages read them again.
    counts = durable(label_counts(df, truth, predicted))
    per_label = (
        vocabulary.join(counts.where("label >= 0"), "label", "left")
        .na.fill(0, ["tp", "fp", "fn"])
        .select(
            "name", "tp", "fp", "fn",
            ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("p"),
            ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("r"),
            ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f"),
            (F.col("tp") + F.col("fn")).alias("support"),
        )
    )
    s = F.sum("support")
    averages = per_label.agg(
        F.array(
            F.struct(
                F.lit("micro avg").alias("name"), ratio(F.sum("tp"), F.sum("tp") + F.sum("fp")).alias("p"),
                ratio(F.sum("tp"), s).alias("r"), ratio(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("fp") + F.sum("fn")).alias("f"), s.alias("support"),
            ),
            F.struct(F.lit("macro avg").alias("name"), F.avg("p").alias("p"), F.avg("r").alias("r"), F.avg("f").alias("f"), s.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("name"), *[ratio(F.sum(F.col(c) * F.col("support")), s).alias(c) for c in ("p", "r", "f")], s.alias("support")
            ),
        ).alias("a")
    ).select(F.inline("a"))
    return per_label.select("name", "p", "r", "f", "support").unionByName(averages).select(
        F.col("name").alias("label"), F.round("p", DIGITS).alias("precision"), F.round("r", DIGITS).alias("recall"),
        F.round("f", DIGITS).alias("f1"), F.col("support").cast("bigint").alias("support"),
    )


MASKED = -100


def ranking_loss_of(logits: Column, labels: Column) -> Column:
    """Loss of one row: log(1 + sum of exp of the negatives' logits) + log(1 + sum of exp of minus the positives').

    Labels of -100 count on neither side. The largest term is taken out before the exponentials.
    """

    def side(wanted: int, sign: int) -> Column:
        pairs = F.filter(F.arrays_zip(logits.alias("x"), labels.alias("y")), lambda p: p["y"] == wanted)
        terms = F.concat(F.transform(pairs, lambda p: p["x"].cast("double") * sign), F.array(F.lit(0.0)))
        return let(
            terms,
            lambda t: let(
                F.array_max(t),
                lambda top: top + F.log(F.aggregate(t, F.lit(0.0), lambda a, v: a + F.exp(v - top))),
            ),
        )

    return side(0, 1) + side(1, -1)


def ranking_loss(df: DataFrame, logits: str = "logits", labels: str = "labels") -> DataFrame:
    """Mean multi-label ranking loss."""
    return df.agg(F.round(F.avg(ranking_loss_of(F.col(logits), F.col(labels))), DIGITS).alias("ranking_loss"))


LOG_FLOOR = -100.0


def cross_entropy_sum(probabilities: Column, truth: Column) -> Column:
    """Sum of binary cross entropies of one row; logarithms are floored so that 0 and 1 stay finite."""

    def log(x: Column) -> Column:
        return F.when(x > 0, F.greatest(F.log(x), F.lit(LOG_FLOOR))).otherwise(F.lit(LOG_FLOOR))

    terms = F.zip_with(
        probabilities, truth, lambda p, y: -(y.cast("double") * log(p.cast("double")) + (1 - y.cast("double")) * log(1 - p.cast("double")))
    )
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def span_loss(
    df: DataFrame,
    start_prob: str = "start_prob",
    end_prob: str = "end_prob",
    start_truth: str = "start_positions",
    end_truth: str = "end_positions",
) -> DataFrame:
    """Mean of the start and the end cross entropy over all positions."""
    rows = df.select(
        cross_entropy_sum(F.col(start_prob), F.col(start_truth)).alias("s"),
        cross_entropy_sum(F.col(end_prob), F.col(end_truth)).alias("e"),
        F.size(start_truth).alias("ns"),
        F.size(end_truth).alias("ne"),
    )
    return rows.agg(F.round((F.sum("s") / F.sum("ns") + F.sum("e") / F.sum("ne")) / 2, DIGITS).alias("span_loss"))
