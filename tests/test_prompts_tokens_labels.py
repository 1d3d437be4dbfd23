import math
import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import labels, prompts, tokens
from spanloom.operators import examples, metrics
from spanloom.schemas import PLAIN_SPANS


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit_array(values):
    return F.array(*[F.lit(v) for v in values])


def test_unify(spark):
    cases = {
        "傾向[正向,負向,正向]": "傾向[正向,負向]", "a[b]c": "a[b]c", "x[b,a]": "x[a,b]", "[b,a]": "[b,a[a,b]", "plain": "plain", "a[c][b,a]": "a[[b,c][a]",
    }
    for given in cases:
        # Written out from the rule: everything before the first bracket behind position 0, then sorted options.
        assert one(spark, prompts.unify_prompt(F.lit(given))) == expected_unify(given), given


def expected_unify(p):
    import re

    m = re.search(r"\[.*?\]$", p)
    if not m:
        return p
    at = p.find("[", 1)
    return p[:at] + "[" + ",".join(sorted(set(m.group()[1:-1].split(",")))) + "]"


def test_prompts_and_label_spans(spark):
    assert one(spark, prompts.relation_prompt(F.lit("甲"), F.lit("父"))) == "甲的父"
    assert one(spark, prompts.relation_prompt(F.lit("A"), F.lit("father"), "en")) == "father of A"
    x = one(spark, prompts.classification_example(F.lit("文"), lit_array(["負向", "無"]), "傾向", ["正向", "負向"]))
    prompt = "傾向[正向,負向]"
    assert x.prompt == prompt
    assert tuple(x.result_list[0]) == ("負向", prompt.rfind("負向") - len(prompt) - 1, prompt.rfind("負向") - len(prompt) - 1 + 2)
    assert x.result_list[1].start == -1 - len(prompt) - 1
    s = one(spark, prompts.split_class_labels(F.lit("food##good##new")))
    assert (s.entity, s.classes) == ("food", ["good", "new"])
    assert one(spark, prompts.split_class_labels(F.lit("food"))).classes is None


def test_shuffled_options_are_permutations(spark):
    rows = spark.range(30).select(prompts.shuffled_options(["a", "b", "c", "d"], 1, F.col("id")).alias("o")).collect()
    assert all(sorted(r.o) == ["a", "b", "c", "d"] for r in rows) and len({tuple(r.o) for r in rows}) > 5


def grouped_by_scan(pairs, lang):
    """Independent scan over all later prompts."""
    link = {"ch": "的", "en": " of"}[lang]

    def shared(a, b):
        if lang == "ch":
            n = max(k for k in range(min(len(a), len(b)) + 1) if a[len(a) - k :] == b[len(b) - k :])
            tail = a[len(a) - n :]
            return tail[1:] if tail.startswith(link) else ""
        n = max(k for k in range(min(len(a), len(b)) + 1) if a[:k] == b[:k])
        return a[: n - 3] if a[:n].endswith(link) else ""

    done, out = set(), []
    for i, (p, v) in enumerate(pairs):
        if p in done:
            continue
        hits = [(shared(p, q), q, w) for q, w in pairs[i + 1 :] if shared(p, q)]
        if hits:
            out.append((hits[0][0], v))
            out += [(s, w) for s, _, w in hits]
            done |= {p, *[q for _, q, _ in hits]}
        else:
            out.append((p.rsplit("的", 1)[1] if lang == "ch" else p.split(" of ", 1)[0], v))
            done.add(p)
    return out


@pytest.mark.parametrize("lang", ["ch", "en"])
def test_group_relations(spark, lang):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        pairs = []
        for n in range(rng.randrange(1, 8)):
            s, p = rng.choice(["甲", "乙", "甲丙", "丁的丙"]), rng.choice(["父", "配偶", "母的父"])
            pairs.append((f"{s}的{p}" if lang == "ch" else f"{p} of {s}", str(n)))
        rows.append((i, pairs))
    df = spark.createDataFrame(rows, "id int, pairs array<struct<prompt:string,value:string>>")
    for r in df.select("id", prompts.group_relations(F.col("pairs"), lang).alias("g")).collect():
        assert [tuple(x) for x in r.g] == grouped_by_scan(rows[r.id][1], lang), rows[r.id]


def offsets_col(pairs):
    return F.array(*[F.struct(F.lit(a).alias("s"), F.lit(b).alias("e")) for a, b in pairs])


def test_token_offsets(spark):
    pairs = [(0, 0), (0, 2), (2, 4), (0, 0), (0, 1), (1, 4), (4, 5), (0, 0), (0, 0)]
    o = offsets_col(pairs)
    assert one(spark, tokens.offset_drift(o)) == 5
    shifted = [tuple(x) for x in one(spark, tokens.drift_offsets(o))]
    assert shifted == [(0, 0), (0, 2), (2, 4), (0, 0), (5, 6), (6, 9), (9, 10), (0, 0), (0, 0)]
    s = offsets_col(shifted)
    assert [one(spark, tokens.align_offset(F.lit(x), s)) for x in (5, 7, 9, 99)] == [4, 5, 6, 7]
    assert [one(spark, tokens.map_offset(F.lit(x), s)) for x in (5, 8, 99)] == [4, 5, -1]
    assert [tuple(x) for x in one(spark, tokens.drift_offsets(offsets_col([(0, 0), (0, 2)])))] == [(0, 0), (0, 2)]


def test_position_vectors(spark):
    content, prompt = "法院判定賠償110元，民國", "醫療費用"
    spans = [("110元", 6, 10)]
    df = spark.createDataFrame([(content, prompt, spans), ("臺", prompt, [("臺", 0, 1)]), ("臺", prompt, [])], f"content string, prompt string, r {PLAIN_SPANS}")
    out = df.select("*", tokens.position_vectors(F.col("r"), tokens.char_offsets(F.col("prompt"), F.col("content"), 32), 32).alias("v")).collect()
    for row in out:
        shown = ["[CLS]", *row.prompt, "[SEP]", *row.content, "[SEP]"]
        starts = [i for i, x in enumerate(row.v.start_positions) if x == 1.0]
        ends = [i for i, x in enumerate(row.v.end_positions) if x == 1.0]
        assert len(row.v.start_positions) == 32
        assert ["".join(shown[a : b + 1]) for a, b in zip(starts, ends)] == [s.text for s in row.r]


def test_padding_bucket(spark):
    got = [one(spark, tokens.padding_bucket(F.lit(n), [512, 128, 256], 768)) for n in (1, 128, 129, 512, 513)]
    assert got == [128, 128, 256, 512, 768]


def test_label_vectors(spark):
    vocabulary = ["a", "b", "c"]
    assert one(spark, labels.label_indexes(lit_array(["c", "a", "z"]), vocabulary)) == [2, 0, None]
    assert one(spark, labels.unknown_labels(lit_array(["c", "z"]), vocabulary)) == ["z"]
    assert one(spark, labels.multi_hot(lit_array([0, -1]), 3)) == [1.0, 0.0, 1.0]
    hits = one(spark, labels.decode_logits(lit_array([0.0, 3.0, -1000.0, 1000.0])))
    assert [h.label for h in hits] == [1, 3] and hits[1].prob == 1.0
    flags = one(spark, labels.label_map(lit_array([2]), vocabulary))
    assert flags == {"a": 0, "b": 0, "c": 1}
    assert one(spark, labels.chosen_labels(labels.label_map(lit_array([2, 0]), vocabulary))) == ["a", "c"]
    assert labels.template_length(["ab", "c"]) == 2 + 3 + 2 + 2 and labels.content_budget(["ab"], 20) == 13


def test_label_examples_and_standard_form(spark):
    df = spark.createDataFrame([(1, "a\tb\tc", ["x"]), (2, "abc", None), (3, "abc", ["q"])], "id int, text string, choices array<string>")
    out = {r.id: r for r in examples.label_examples(df, ["w", "x"]).collect()}
    assert (out[1].text_a, out[1].text_b, out[1].labels, out[1].question) == ("ab", "c", [1], "")
    assert out[2].labels == [] and out[3].reject_reason == "label not in vocabulary: q"
    with pytest.raises(Exception, match="not in vocabulary"):
        examples.label_examples(df, ["w", "x"], strict=True).collect()
    raw = spark.createDataFrame(
        [("abc", None, "", ["x", "y"], "[0, 1]"), ("abc", "b", "", ["x", "y"], "1"), ("ab", None, "", ["x", "y"], "1"), ("abc", None, "", ["x"], "0"), (None, None, "", ["x", "y"], "0")],
        "text_a string, text_b string, question string, choices array<string>, labels string",
    )
    std = examples.standard_label_examples(raw).collect()
    assert [(r.text_b, r.labels) for r in std] == [("", [1.0, 1.0]), ("b", [0.0, 1.0])]
    assert tuple(examples.skipped_examples(raw).first()) == (2, 3)
    unlabelled = examples.standard_label_examples(raw.drop("labels", "text_b").withColumn("more", F.lit(1)), is_test=True)
    assert "more" in unlabelled.columns and unlabelled.count() == 2
    assert examples.inference_rows(raw.select(F.col("text_a").alias("text")), ["p", "q"]).first().choices == ["p", "q"]


def test_metrics_against_counts(spark):
    rng = random.Random(6)
    rows = [(i, [rng.randrange(2) for _ in range(5)] + [0], [rng.randrange(2) for _ in range(5)] + [0]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, labels array<int>, predicted array<int>")
    tp, fp, fn = [0] * 6, [0] * 6, [0] * 6
    for _, y, p in rows:
        for i in range(6):
            tp[i] += y[i] and p[i]
            fp[i] += (not y[i]) and p[i]
            fn[i] += y[i] and (not p[i])
    f = [2 * a / (2 * a + b + c) if a + b + c else 0.0 for a, b, c in zip(tp, fp, fn)]
    got = metrics.multilabel_metrics(df, 6).first()
    assert got.micro_f1 == pytest.approx(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), abs=1e-6)
    assert got.macro_f1 == pytest.approx(sum(f) / 6, abs=1e-6)
    assert got.accuracy == pytest.approx(sum(y == p for _, y, p in rows) / 200, abs=1e-6)
    assert got.precision == pytest.approx(sum(tp) / (sum(tp) + sum(fp)), abs=1e-6)
    report = {r.label: r for r in metrics.label_report(df, list("abcdef")).collect()}
    assert report["f"].support == 0 and report["a"].f1 == pytest.approx(f[0], abs=1e-6)
    weights = [a + c for a, c in zip(tp, fn)]
    assert report["weighted avg"].f1 == pytest.approx(sum(x * w for x, w in zip(f, weights)) / sum(weights), abs=1e-6)


def test_losses(spark):
    df = spark.createDataFrame([([2.0, -1.0, 700.0], [1, 0, -100]), ([1000.0, -1000.0, 0.0], [0, 1, 0])], "logits array<double>, labels array<int>")
    a = math.log(1 + math.exp(-1.0)) + math.log(1 + math.exp(-2.0))
    b = 1000.0 + 1000.0
    assert metrics.ranking_loss(df).first().ranking_loss == pytest.approx((a + b) / 2, abs=1e-5)
    p = spark.createDataFrame([([0.9, 0.0], [0.5, 1.0], [1.0, 0.0], [1.0, 0.0])], "start_prob array<double>, end_prob array<double>, start_positions array<double>, end_positions array<double>")
    start, end = -math.log(0.9) / 2, (-math.log(0.5) + 100) / 2
    assert metrics.span_loss(p).first().span_loss == pytest.approx((start + end) / 2, abs=1e-6)


def test_span_metrics(spark):
    s = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame(
        [("a", [(0, 1), (2, 3)], [(0, 1)]), ("b", [], [(5, 6)]), ("b", [(1, 2)], [(1, 2), (1, 2)])], f"entity string, gold {s}, predicted {s}"
    )
    total = metrics.span_metrics(df).first()
    assert (total.correct, total.predicted, total.gold) == (2, 3, 3)
    by = {r.entity: r for r in metrics.span_metrics(df, by="entity").collect()}
    assert by["a"].recall == 0.5 and by["total"].f1 == total.f1 == pytest.approx(2 / 3, abs=1e-6)
    assert metrics.distinguishing_prefix(["abc", "bc"]) == 2
    with pytest.raises(ValueError):
        metrics.distinguishing_prefix(["ab", "abc"])
    assert one(spark, metrics.prefix_entity(F.lit("收入多少"), ["收入", "年齡"])) == "收入"
