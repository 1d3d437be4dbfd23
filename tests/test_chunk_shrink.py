import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators.chunk import check_capacity, chunk_examples
from spanloom.operators.shrink import greedy_distinct, shrink_documents, shrink_to_spans, span_windows
from spanloom.functions.rules import default_rules
from spanloom.schemas import PLAIN_SPANS, SPANS


def examples(spark, rows):
    return spark.createDataFrame(rows, f"id int, content string, prompt string, result_list {PLAIN_SPANS}")


def walk(length, capacity, spans):
    """Greedy walk: end a chunk at the capacity, or at the start of a span that would be split."""
    cuts, at = [], 0
    while at < length:
        end = at + capacity
        for a, b in spans:
            if at < a < end < b:
                end = a
                break
        cuts.append((at, min(end, length)))
        at = end
    return cuts


def random_case(rng, capacity, longest):
    length = rng.randrange(1, longest)
    spans, at = [], 0
    while True:
        a = at + rng.randrange(0, 3 * capacity if rng.random() < 0.3 else 6)
        b = a + rng.randrange(1, capacity + 1)
        if b > length or len(spans) > 12:
            return length, spans
        spans.append((a, b))
        at = b


def test_chunks_match_greedy_walk(spark):
    rng, rows, expected = random.Random(7), [], {}
    for i in range(300):
        capacity = rng.randrange(2, 30)
        prompt = "p" * (40 - 3 - capacity)
        length, spans = random_case(rng, capacity, 200)
        content = "".join(rng.choice("甲乙丙丁ab𠀀") for _ in range(length))
        rows.append((i, content, prompt, [(content[a:b], a, b) for a, b in spans][::-1]))
        expected[i] = (content, walk(length, capacity, spans), spans)
    got = {}
    for r in chunk_examples(examples(spark, rows), 40).orderBy("id", "chunk_no").collect():
        assert r.reject_reason is None
        got.setdefault(r.id, []).append(r)
    for i, (content, cuts, spans) in expected.items():
        assert [(r.chunk_start, r.chunk_start + len(r.content)) for r in got[i]] == cuts
        assert "".join(r.content for r in got[i]) == content
        found = [(r.chunk_start + s.start, r.chunk_start + s.end) for r in got[i] for s in r.result_list]
        assert found == spans
        assert all(r.content[s.start : s.end] == s.text for r in got[i] for s in r.result_list)


def test_long_document(spark):
    rng = random.Random(8)
    content = "".join(rng.choice("一二三四五") for _ in range(30_000))
    spans = [(content[a : a + 4], a, a + 4) for a in (8877, 9415, 29_990)]
    out = chunk_examples(examples(spark, [(1, content, "精神慰撫金額", spans)]), 512).orderBy("chunk_no").collect()
    assert "".join(r.content for r in out) == content
    first = next(r for r in out if r.result_list)
    assert first.chunk_no == 8877 // 503 and first.result_list[0].start == 8877 % 503


def test_golden_edges(spark):
    base = "臺灣苗栗地方法院民事裁定110年度苗簡字第563號原告何婷婷被告黃晨峯上列被告因過失傷害案件，法院判定賠償110元，民國50年三月110元"
    assert base[65:69] == "110元" and len(base) == 69
    cross = chunk_examples(examples(spark, [(1, base + base, "醫療費用", [("110元", 65, 69)])]), 75).orderBy("chunk_no").collect()
    assert len(cross[0].content) == 65 and len(cross[1].content) == 68
    assert (cross[1].result_list[0].start, cross[1].result_list[0].end) == (0, 4)
    tiles = [(0, 2), (2, 8), (9, 17), (17, 51), (51, 65), (65, 69)]
    full = chunk_examples(examples(spark, [(1, base, "醫療費用", [(base[a:b], a, b) for a, b in tiles])]), 41)
    assert sum(len(r.result_list) for r in full.collect()) == 6
    assert full.where("reject_reason is not null").count() == 0
    whole = chunk_examples(examples(spark, [(1, base, "醫療費用", [(base, 0, 69)])]), 4 + 3 + 69).collect()
    assert len(whole) == 1 and whole[0].result_list[0].end == 69


def test_overlapping_spans(spark):
    """Overlaps within a chunk stay; a span that a cut goes through rejects its row, also in lenient mode."""
    rows = [
        (1, "abcdefghij", "p", [("abcd", 0, 4), ("cdef", 2, 6)]),
        (2, "abcdefghij", "p", [("abc", 0, 3), ("abcde", 0, 5), ("fg", 5, 7)]),
        (3, "abcdefghij", "p", [("cdef", 2, 6), ("efgh", 4, 8)]),
    ]
    for strict in (True, False):
        out = chunk_examples(examples(spark, rows), 64, strict=strict).collect()
        assert {r.id: (r.reject_reason, len(r.result_list)) for r in out} == {1: (None, 2), 2: (None, 3), 3: (None, 2)}
        cut = chunk_examples(examples(spark, rows), 4 + 6, strict=strict).orderBy("id", "chunk_no").collect()
        assert {r.id: r.reject_reason for r in cut} == {1: None, 2: None, 3: "a cut goes through a span"}
        assert [len(r.result_list) for r in cut if r.id == 1] == [2, 0] and [len(r.result_list) for r in cut if r.id == 2] == [2, 1]


def test_rejects(spark):
    rows = [
        (1, "abcdef", "p", [("ab", 1, 3)]),
        (2, "abcdefgh", "p", [("abcdefg", 0, 7)]),
        (3, "abcdef", "p", [("abc", 0, 3), ("cd", 2, 4)]),
        (4, "abcdef", "p", [("", 3, 2)]),
        (5, "abc", "p" * 20, []),
        (6, "", "p", []),
    ]
    out = {r.id: r.reject_reason for r in chunk_examples(examples(spark, rows), 10).collect()}
    assert out == {
        1: "slice differs from span text", 2: "span longer than a chunk", 3: None, 4: "start after end", 5: "max_seq_len is too small",
    }
    with pytest.raises(ValueError, match="max_seq_len"):
        check_capacity(9, ["精神慰撫金額"])


def test_stripping_moves_spans(spark):
    out = chunk_examples(examples(spark, [(1, " \n　abcdef ", "p", [("cd", 5, 7)])]), 8).orderBy("chunk_no").collect()
    assert [(r.content, [tuple(s) for s in r.result_list]) for r in out] == [("abcd", [("cd", 2, 4)]), ("ef", [])]


def test_lenient(spark):
    rows = [(1, " abc ", "p", [("abc", 1, 4)]), (2, "abcdefgh", "p", [("abcdefg", 0, 7), ("h", 7, 8)]), (3, "", "p", [])]
    out = chunk_examples(examples(spark, rows), 8, strict=False).orderBy("id", "chunk_no").collect()
    assert (out[0].content, tuple(out[0].result_list[0])) == (" abc ", ("abc", 1, 4))
    two = [r for r in out if r.id == 2]
    assert [r.content for r in two] == ["abcd", "efgh"] and [s.text for s in two[0].dropped_spans] == ["abcdefg"]
    assert [s.text for s in two[1].result_list] == ["h"]
    assert [r.content for r in out if r.id == 3] == [""]


# --- shrinking ------------------------------------------------------------------------------------


def keep(spans, threshold):
    out = []
    for s in spans:
        if s["probability"] > threshold and all(s["start"] != k["start"] and s["end"] != k["end"] for k in out):
            out.append(s)
    return out


def windowed(text, spans, budget, threshold, dynamic, compat):
    kept = keep(spans, threshold)
    if not kept:
        return ""
    limit = len(text) - (1 if compat else 0)
    width = round(budget / len(kept))
    boxes = []
    for s in kept:
        half = round((width - (s["end"] - s["start"])) / 2)
        boxes.append([max(s["start"] - half, 0), min(s["end"] + half, limit)])
    boxes.sort(key=lambda b: b[0])
    out, last, saved = "", -1, 0
    for i, (a, b) in enumerate(boxes):
        if dynamic and saved > 0:
            a, b = max(round(a - saved / 2), 0), min(round(b + saved / 2), limit)
        if a < last:
            remaining = len(boxes) - i - 1
            if dynamic:
                saved += round((last - a) / remaining) if remaining else last - a
                if not remaining:
                    b = b + round(saved / 2) if b + saved < limit else limit
            out += text[last:b] if b > last else ""
        else:
            out += text[a:b] if b > a else ""
        last = b if compat else max(b, last)
    return out


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("dynamic", [False, True])
def test_shrink_matches_loop(spark, compat, dynamic):
    rng, rows = random.Random(9), []
    for i in range(250):
        text = "".join(chr(0x4E00 + rng.randrange(300)) for _ in range(rng.randrange(1, 400)))
        spans = []
        for n in range(rng.randrange(0, 9)):
            a = rng.randrange(len(text))
            spans.append(dict(entity="e", ord=n, start=a, end=min(len(text), a + rng.randrange(1, 40)), text="", probability=rng.random()))
        rows.append((i, text, spans, rng.randrange(1, 300)))
    df = spark.createDataFrame([(i, t, [tuple(s.values()) for s in ss], b) for i, t, ss, b in rows], f"id int, text string, spans {SPANS}, budget int")
    out = df.select("id", shrink_to_spans(F.col("text"), F.col("spans"), F.col("budget"), 0.4, dynamic, compat).alias("x")).collect()
    for r in out:
        _, text, spans, budget = rows[r.id]
        assert r.x == windowed(text, spans, budget, 0.4, dynamic, compat), r.id


def test_greedy_distinct_and_windows(spark):
    spans = [("a", 0, 3, 9, "", 0.9), ("b", 0, 3, 5, "", 0.9), ("c", 0, 1, 9, "", 0.9), ("d", 0, 1, 2, "", 0.1), ("e", 0, 0, 1, "", 0.41)]
    df = spark.createDataFrame([(spans,)], f"spans {SPANS}")
    kept = greedy_distinct(F.col("spans"), 0.4)
    row = df.select(kept.alias("k"), span_windows(kept, F.lit(9), F.lit(10)).alias("w")).first()
    assert [s.entity for s in row.k] == ["a", "e"]
    assert [tuple(w) for w in row.w] == [(0, 5), (1, 10)]


def test_shrink_documents_with_rules_and_truncation(spark):
    df = spark.createDataFrame([(1, "甲" * 50 + "受有傷害" + "乙" * 50, []), (2, "丙" * 30, [])], f"id int, text string, spans {SPANS}")
    rules = default_rules(["年齡", "肇責", "受有傷害"])
    out = {r.id: r.text for r in shrink_documents(df, 20, rules).collect()}
    assert "受有傷害" in out[1] and len(out[1]) <= 24 and out[2]
    plain = {r.id: r.text for r in shrink_documents(df, 20).collect()}
    assert plain[1] == "甲" * 20 and plain[2] == "丙" * 20
