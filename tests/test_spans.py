import random
import re

import pytest
from pyspark.sql import functions as F

from spanloom.constants import ENTITY_TYPES
from spanloom.functions import rules, text
from spanloom.operators import spans as ops
from spanloom.operators.regularize import regularize
from spanloom.operators.validate import accepted, rejected
from spanloom.schemas import SPANS

ALPHABET = "年歲5的 \n　過失責任肇事%％分之/受有傷害勢出生發產ab\u0085 𠀀"


def texts(n, seed, longest=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(n)]


def by_finditer(pattern, value, only_first=False):
    found = [(m.start(), m.end(), m.group()) for m in re.finditer(pattern, value)]
    return found[:1] if only_first else found


def naive_rule(rule, value):
    for pattern in (rule.first, rule.second):
        found = by_finditer(pattern, value, rule.only_first_match and pattern == rule.first)
        if found:
            return found
    return [(0, 1, rule.default_text)]


@pytest.mark.parametrize("rule", [rules.AGE_RULE, rules.LIABILITY_RULE, rules.INJURY_RULE])
def test_rules_find_what_finditer_finds(spark, rule):
    values = texts(150, 1) + ["", "原告民國五十年出生", "受有輕傷害，又受有重傷害", "他負百分之三十過失責任", "部分之"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    for row in df.select("t", rules.apply_rule(F.col("t"), rule).alias("s")).collect():
        assert [tuple(s) for s in row.s] == naive_rule(rule, row.t)


def test_clean_and_strip(spark):
    values = texts(50, 2) + ["\\n a\\ n　b", "  x  ", " \x1c", ""]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    out = df.select(
        "t", text.clean_text(F.col("t")).alias("c"), text.strip_text(F.col("t")).alias("s"),
        text.stripped_prefix(F.col("t")).alias("p"), text.has_fullwidth_space(F.col("t")).alias("w"),
    )
    for r in out.collect():
        cleaned = r.t
        for special in ("\n", " ", "　", "\\n"):
            cleaned = cleaned.replace(special, "")
        assert r.c == cleaned
        assert r.s == r.t.strip()
        assert r.p == len(r.t) - len(r.t.lstrip())
        assert r.w == ("　" in r.t)


def test_split_pair(spark):
    df = spark.createDataFrame([("a",), ("a\tb",), ("a\tb\tc",), ("",), ("\t",)], "t string")
    got = [tuple(r.p) for r in df.select(text.split_pair(F.col("t")).alias("p")).collect()]
    assert got == [("a", ""), ("a", "b"), ("ab", "c"), ("", ""), ("", "")]


def test_blocks_read_like_slices(spark, monkeypatch):
    long_text = "".join(random.Random(3).choice(ALPHABET) for _ in range(9000))
    df = spark.createDataFrame([(long_text, a, b) for a in (0, 1, 4095, 4096, 5000, 8999) for b in (0, 1, 4096, 4097, 8192, 9000)], "t string, a int, b int")
    out = df.select("t", "a", "b", text.read_blocks(text.text_blocks(F.col("t")), F.col("a"), F.col("b")).alias("x"))
    for r in out.collect():
        assert r.x == r.t[r.a : max(r.b, r.a)]


def doc(spark, rows):
    return spark.createDataFrame(rows, f"doc_id int, text string, spans {SPANS}")


def span(entity, start, end, value, probability=1.0, ord=0):
    return (entity, ord, start, end, value, probability)


DIRTY = [
    ("臺灣苗栗\n地方法\n\n\n院 民事裁\n\n \n\n\n定110年度苗 簡\n\n\n\n字第563號賠償100\n\n \n\n\n \n元原告", [(43, 55, "100\n\n \n\n\n \n元")]),
    ("\n\n 　 \n", []),
    ("法院判定賠償110元，民國50年三月。", [(6, 10, "110元")]),
    ("賠償110元\n\n 　 \n。黃晨\n 100\n0元 　 \n苗2\n 5000元　年告\n5 3　0\n元", None),
]


def test_regularize_golden(spark):
    rows = []
    for i, (value, found) in enumerate(DIRTY):
        if found is None:
            found = [(m.start(), m.end(), m.group()) for m in re.finditer(r"110元|100\n0元|2\n 5000元|5 3　0\n元", value)][::-1]
            assert len(found) == 4
        rows.append((i, value, [span("e", a, b, t) for a, b, t in found]))
    out = regularize(doc(spark, rows)).orderBy("doc_id").collect()
    for row, (_, original, given) in zip(out, rows):
        assert row.reject_reason is None
        assert row.text == re.sub("[\n 　]", "", original)
        assert len(row.spans) == len(given)
        for s in row.spans:
            assert row.text[s.start : s.end] == s.text


def test_regularize_random_and_rejects(spark):
    rng = random.Random(4)
    rows = []
    for i, value in enumerate(texts(120, 5, 400) + ["x \n" * 4000]):
        starts = [rng.randrange(len(value)) for _ in range(6)] if value else []
        spans = [span("e", a, min(len(value), a + rng.randrange(1, 9)), value[a : a + 8]) for a in starts]
        spans = [span("e", s[2], s[3], value[s[2] : s[3]]) for s in spans]
        rows.append((i, value, spans))
    df = regularize(doc(spark, rows))
    n_rejects = 0
    for row in df.collect():
        original, given = rows[row.doc_id][1], rows[row.doc_id][2]
        specials = lambda x: sum(c in "\n 　" for c in original[:x])
        bad = False
        for s, g in zip(row.spans, given):
            assert (s.start, s.end) == (g[2] - specials(g[2]), g[3] - 1 - specials(g[3] - 1) + 1)
            bad |= row.text[s.start : s.end] != s.text
        assert (row.reject_reason is not None) == bad
        n_rejects += bad
    assert accepted(df).count() == len(rows) - n_rejects and rejected(df).count() == n_rejects > 0


def test_regularize_strict_and_parameter_check(spark):
    bad = doc(spark, [(1, "a b", [span("e", 0, 2, "a ")])])
    with pytest.raises(Exception, match="differs from span text"):
        regularize(bad, strict=True).collect()
    with pytest.raises(ValueError):
        regularize(bad, specials=["ab"])


RESULT = [
    span("精神慰撫金額", 5188, 5196, "150,000元", 0.9, 0),
    span("精神慰撫金額", 5507, 5514, "150,000", 0.9, 1),
    span("薪資收入", 4452, 4458, "80,856", 0.98, 0),
    span("薪資收入", 123, 456, "999", 0.99, 1),
]
NAMES = ["精神慰撫金額", "薪資收入", "醫療費用"]


def test_strategies(spark):
    df = doc(spark, [(1, "t", RESULT), (2, "t", [])])
    top = ops.select_spans(df, "max").orderBy("doc_id").collect()
    assert [s.text for s in top[0].spans] == ["150,000元", "999"] and top[1].spans == []
    over = ops.select_spans(df, "threshold", 0.9).orderBy("doc_id").first()
    assert [s.text for s in over.spans] == ["80,856", "999"]
    assert ops.select_spans(df, "all").orderBy("doc_id").first().spans == df.orderBy("doc_id").first().spans
    ends = ops.select_spans(df, lambda spans, t: F.slice(spans, -1, 1)).orderBy("doc_id").first()
    assert [s.text for s in ends.spans] == ["999"]
    with pytest.raises(ValueError):
        ops.select_spans(df, "__import__")


def test_fill_and_flat_table(spark):
    df = doc(spark, [(1, "t", RESULT), (2, "t", [])])
    filled = ops.fill_missing(df, NAMES).orderBy("doc_id").collect()
    assert [s.entity for s in filled[0].spans][-1] == "醫療費用" and len(filled[1].spans) == 3
    assert tuple(filled[1].spans[0])[2:] == (-1, -1, "nan", 0.0)
    flat = ops.flat_entity_table(df, NAMES, ["text", "start", "end", "probability"]).orderBy("doc_id").collect()
    assert flat[0]["精神慰撫金額"] == "150,000元" and flat[0]["薪資收入"] == "999" and flat[0]["醫療費用"] == "nan"
    assert flat[0]["uie_result_start_index_for_薪資收入"] == 123 and flat[1]["uie_result_probability_for_薪資收入"] == 0.0
    assert "text" not in flat[0].asDict() and "spans" not in flat[0].asDict()
    kept = ops.flat_entity_table(df, NAMES, drop=[])
    assert {"text", "spans"} <= set(kept.columns)
    assert "doc_id" not in ops.flat_entity_table(df, NAMES, drop=["text", "spans", "doc_id"]).columns


def test_long_table_agrees_with_arrays(spark):
    df = doc(spark, [(1, "t", RESULT), (2, "t", [])])
    long = ops.span_rows(df, ["doc_id"])
    top = ops.top_span(long, ["doc_id", "entity"]).orderBy("start").collect()
    assert [r.text for r in top] == ["999", "150,000元"]
    assert ops.export_rows(df.withColumn("spans", F.transform("spans", lambda s: s.withField("probability", F.lit(0.5)))), ["doc_id"]).count() == 4
    assert ops.span_rows(df, ["doc_id"], threshold=0.98, inclusive=False).count() == 1


def test_entity_map_round_trip(spark):
    df = doc(spark, [(1, "t", RESULT), (2, "t", [])])
    back = df.withColumn("m", ops.as_entity_map(F.col("spans"))).withColumn("b", ops.from_entity_map(F.col("m"))).orderBy("doc_id").collect()
    assert back[0].b == back[0].spans and back[1].b == []
    kept = df.select(ops.keep_keys(F.col("spans"), ["start"]).alias("k")).first()
    assert kept.k[0].asDict() == {"start": 5188}


def test_rules_only_where_model_is_silent(spark):
    table = rules.default_rules(["年齡", "肇責", "受有傷害"])
    df = doc(spark, [(1, "出生 受有傷", [span("年齡", 1, 2, "x")])])
    got = ops.rules_where_empty(df, table).first().spans
    assert [(s.entity, s.start, s.text) for s in got] == [("年齡", 1, "x"), ("肇責", 0, "預設輸出"), ("受有傷害", 3, "受有"), ("受有傷害", 5, "傷")]


def test_entity_defaults():
    assert len(ENTITY_TYPES) == 6


def test_many_matches_in_one_text(spark):
    """Time grows with the matches, not with their square."""
    import time

    from spanloom.functions.rules import Rule, find_all
    from spanloom.operators.shrink import greedy_distinct

    n = 32_000
    text = "".join(f"x{i % 10}y" for i in range(n))
    df = spark.createDataFrame([(text,), ("none",), ("a1",)], "t string").repartition(1).cache()
    df.count()
    began = time.time()
    found = df.select("t", find_all(F.col("t"), "[0-9]").alias("s")).collect()
    assert time.time() - began < 20
    spans = max((r.s for r in found), key=len)
    assert [(s.start, s.end, s.text) for s in spans] == [(3 * i + 1, 3 * i + 2, str(i % 10)) for i in range(n)]
    assert [[(s.start, s.text) for s in r.s] for r in found if len(r.t) < 9] == [[], [(1, "1")]]
    spread = F.transform(F.sequence(F.lit(0), F.lit(8000)), lambda i: F.struct(F.lit("e").alias("entity"), i.alias("ord"), (i * 2).alias("start"), (i * 2 + 1).alias("end"), F.lit("t").alias("text"), F.lit(0.9).alias("probability")))
    began = time.time()
    assert spark.range(1).select(F.size(greedy_distinct(spread)).alias("n")).first().n == 8001
    assert time.time() - began < 20
    with pytest.raises(ValueError, match="empty string"):
        Rule(first="[0-9]*")
