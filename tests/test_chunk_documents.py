"""Chunks of all prompts of a document in one plan, against the plan for each prompt and against a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions.common import running
from spanloom.operators.chunk import chunk_documents, chunk_examples, chunk_summaries, cut_plan
from spanloom.operators.examples import prompt_examples
from spanloom.plans import queries

SPANS = "array<struct<entity:string,start:int,end:int,text:string>>"
PROMPTS = ["p", "q", "long prompt", "none"]


def documents(spark, rows):
    return spark.createDataFrame(rows, f"id int, text string, spans {SPANS}")


def random_documents(n, longest, overlap):
    rng, rows = random.Random(5), []
    for i in range(n):
        text = " \n" * rng.randrange(3) + "".join(rng.choice("甲乙丙丁ab𠀀 ") for _ in range(rng.randrange(longest))) + "\t" * rng.randrange(3)
        spans = []
        for _ in range(rng.randrange(9) if text else 0):
            a = rng.randrange(len(text))
            b = min(len(text), a + rng.randrange(1, 12))
            wrong = rng.random() < 0.03
            spans.append((rng.choice(PROMPTS[:3]), b if wrong else a, a if wrong else b, text[a:b] if rng.random() < 0.97 else "?"))
        if not overlap:
            spans = [s for k, s in enumerate(spans) if all(s[2] <= t[1] or t[2] <= s[1] for t in spans[:k])]
        rows.append((i, text, spans))
    return [*rows, (9000, None, None), (9001, "", []), (9002, " \t ", None), (9003, "a b", [("p", 0, 1, "a"), ("p", 0, 3, "a b"), ("p", 0, 2, "a ")])]


def shown(df, strict):
    extra = [] if strict else ["dropped_spans"]
    return sorted(
        ((r.id, r.prompt, r.chunk_no, r.chunk_start, r.content, [tuple(s) for s in r.result_list], r.reject_reason, *[[tuple(s) for s in r[c]] for c in extra]) for r in df.collect()),
        key=repr,
    )


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize(("longest", "max_len", "overlap"), [(60, 14, True), (60, 24, True), (200, 18, False), (40, 8, False)])
def test_as_for_each_prompt(spark, strict, longest, max_len, overlap):
    docs = documents(spark, random_documents(150, longest, overlap)).repartition(4)
    one = chunk_documents(docs, PROMPTS, max_len, strict=strict)
    each = chunk_examples(prompt_examples(docs.where("text IS NOT NULL"), PROMPTS), max_len, strict=strict)
    assert shown(one, strict) == shown(each, strict)


def test_long_text_with_many_spans(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("一二三四五") for _ in range(60_000))
    starts = sorted(rng.sample(range(59_000), 3_000))
    spans = [("p", a, a + rng.randrange(1, 9), "") for a in starts]
    spans = [(e, a, b, text[a:b]) for e, a, b, _ in spans if b <= len(text)]
    kept = [s for k, s in enumerate(spans) if k == 0 or s[1] >= spans[k - 1][2]]
    rows = chunk_documents(documents(spark, [(1, text, kept)]), ["p"], 54).orderBy("chunk_no").collect()
    assert "".join(r.content for r in rows) == text and [r.chunk_no for r in rows] == list(range(len(rows)))
    found = [(r.chunk_start + s.start, s.text) for r in rows for s in r.result_list]
    assert found == [(a, t) for _, a, _, t in kept] and all(r.content[s.start : s.end] == s.text for r in rows for s in r.result_list)


def test_overlaps_inside_and_across_a_cut(spark):
    rows = [(1, "abcdefghij", [("p", 0, 4, "abcd"), ("p", 2, 6, "cdef")]), (2, "abcdefghij", [("p", 2, 6, "cdef"), ("p", 4, 8, "efgh"), ("q", 4, 8, "efgh")])]
    out = chunk_documents(documents(spark, rows), ["p", "q"], 4 + 6).collect()
    assert {(r.id, r.prompt, r.reject_reason) for r in out} == {(1, "p", None), (1, "q", None), (2, "p", "a cut goes through a span"), (2, "q", None)}
    assert [s.text for r in out if (r.id, r.prompt) == (1, "p") for s in r.result_list] == ["abcd", "cdef"]


def test_cut_plan_of_equal_starts(spark):
    spans = F.lit(None).cast("array<struct<start:int,end:int>>")
    frame = spark.createDataFrame([([(4, 9), (4, 6), (12, 14)],)], "spans array<struct<start:int,end:int>>")
    plan = frame.select(cut_plan(F.lit(20), F.lit(6), F.col("spans")).alias("p"), cut_plan(F.lit(20), F.lit(6), F.coalesce(spans, F.array())).alias("q")).first()
    assert (plan.p.starts, plan.p.places) == ([0, 4, 10, 16], [1, 1, 2]) and (plan.q.starts, plan.q.places) == ([0, 6, 12, 18], [])


def test_one_strip_and_one_block_array(spark):
    plan = chunk_documents(documents(spark, []), PROMPTS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("Generate") == 1 and "Exchange" not in plan


def test_columns_of_the_result(spark):
    docs = documents(spark, [(1, "abc", [])])
    assert chunk_documents(docs.withColumn("other", F.lit(1)), ["p"]).columns == ["id", "other", "prompt", "chunk_no", "chunk_start", "content", "result_list", "reject_reason"]
    for bad in (docs.withColumn("prompt", F.lit("x")), docs.withColumn("reject_reason", F.lit("x"))):
        with pytest.raises(ValueError, match="Columns of the result"):
            chunk_documents(bad, ["p"])


def test_running_totals_of_many(spark):
    values = F.sequence(F.lit(1), F.lit(2000))
    total = running(values, F.lit(0), lambda s, x: F.struct((s + x).alias("state"), (s + x).alias("out")), "int")
    empty = running(F.array().cast("array<int>"), F.lit(7), lambda s, x: F.struct((s + x).alias("state"), x.alias("out")), "int")
    row = spark.range(1).select(total.alias("t"), empty.alias("e")).first()
    assert row.t.state == 2001000 and row.t.out == [n * (n + 1) // 2 for n in range(1, 2001)] and (row.e.state, row.e.out) == (7, [])


def test_rejects_alone(spark):
    """Only the rows with a reason, the same as of all rows, and no content is read for the others."""
    df = documents(spark, random_documents(80, 90, True))
    for size in (14, 24):
        every = chunk_documents(df, PROMPTS, size)
        alone = chunk_documents(df, PROMPTS, size, rejects=True)
        assert shown(alone, True) == shown(every.where("reject_reason IS NOT NULL"), True) != []
    # Most documents have chunks but no reason.
    assert alone.count() < every.count() / 2


def test_summaries_stay_with_their_document(spark):
    """Summed up within the document as by an exchange of all chunks; documents may share an id."""
    df = documents(spark, [*random_documents(60, 90, True), *random_documents(20, 50, True)])
    found = chunk_documents(df.withColumn("row", F.monotonically_increasing_id()), PROMPTS, 24)
    piece = F.struct("chunk_no", F.col("content").alias("shown"))
    every = found.groupBy("id", "row", "prompt", "reject_reason").agg(F.count("*"), F.sum(F.size("result_list")), F.array_sort(F.collect_list(piece)))
    got = chunk_summaries(df, PROMPTS, lambda c: c["content"], 24)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, got.select("id", "prompt", "reject_reason", "n_chunks", "n_spans", "pieces").rdd.map(tuple).collect())) == sorted(
        repr(tuple(r)) for r in every.drop("row").toDF("id", "prompt", "reject_reason", "n_chunks", "n_spans", "pieces").rdd.collect()
    )


def test_overlap_digests_of_shared_ids(spark):
    texts = [(1, "mail a.b@example.com and 1.2.3.4, on and on " * 9), (1, "mail c@example.com or 5.6.7.8 " * 7), (None, "10.0.0.1 here"), (None, "none"), (2, "x" * 300), (3, None), (4, "")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = chunk_documents(queries._with_overlaps(queries.with_spans(docs)), queries.ENTITY_NAMES, queries.OVERLAP_CHUNK)
    text = F.concat_ws(":", F.col("chunk_start").cast("string"), F.length("content").cast("string"), queries.show_spans(F.col("result_list"), "start", "end", "text"))
    pieces = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", text.alias("shown")))), lambda p: p["shown"]), "|")
    every = rows.groupBy("doc_id", "prompt", "reject_reason").agg(F.count("*"), F.sum(F.size("result_list")), F.md5(pieces.cast("binary")))
    assert sorted(repr(tuple(r)) for r in queries._overlap_digests(docs).collect()) == sorted(repr(tuple(r)) for r in every.collect())
