import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import examples, negatives, ranks, splits
from spanloom.operators.annotate import attach_text, export_labels, export_spans
from spanloom.operators.merge import HOT_PARTS, _split_hot_join, expand_labels, key_counts, merge_guard, merge_results
from spanloom.plans.classification import merge_tables
from spanloom.plans.training import split_annotations, split_corpus
from spanloom.schemas import ANNOTATED, ENTITIES, RELATIONS, SPANS

CORPUS = f"id int, text string, entities {ENTITIES}, relations {RELATIONS}"


def corpus_rows(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [rng.choice("甲乙丙丁戊己庚辛") + str(rng.randrange(6)) for _ in range(6)]
        text = "".join(words)
        entities = [(k, rng.choice(["人", "地", "物##好", "物", "時"]), 2 * k, 2 * k + 2) for k in range(rng.randrange(0, 6))]
        relations = []
        if len(entities) > 1 and rng.random() < 0.7:
            for r in range(rng.randrange(1, 4)):
                a, b = rng.sample(range(len(entities)), 2)
                relations.append((r, a, b, rng.choice(["屬於", "位於", "父"])))
        rows.append((i, text, entities, relations))
    return rows


def facts_of(row):
    i, text, entities, relations = row
    name = {e[0]: text[e[2] : e[3]] for e in entities}
    return {
        "labels": {e[1].split("##")[0] for e in entities},
        "names": set(name.values()),
        "subjects": list(dict.fromkeys(name[a] for _, a, _, _ in relations)),
        "predicates": [p for _, _, _, p in relations],
        "inverse": [f"{name[b]}的{p}" for _, _, b, p in relations],
        "prompts": {f"{name[a]}的{p}" for _, a, _, p in relations},
    }


@pytest.fixture(scope="module")
def corpus(spark):
    rows = corpus_rows(80, 3)
    return rows, spark.createDataFrame(rows, CORPUS)


def test_train_examples(spark, corpus):
    rows, df = corpus
    ratio = 5
    out = examples.build_extraction_examples(df, "id", ratio, options=["好", "壞"]).collect()
    facts = {r[0]: facts_of(r) for r in rows}
    labels = set().union(*[f["labels"] for f in facts.values()])
    names = set().union(*[f["names"] for f in facts.values()])
    texts = {r[0]: r[1] for r in rows}
    for i, f in facts.items():
        mine = [r for r in out if r.id == i]
        assert all(r.content == texts[i] for r in mine)
        assert all(r.content[s.start : s.end] == s.text for r in mine if r.kind != "aspect" for s in r.result_list)
        positive = {r.prompt for r in mine if r.kind == "entity" and r.result_list}
        negative = [r.prompt for r in mine if r.kind == "entity" and not r.result_list]
        assert positive == f["labels"]
        missing = labels - f["labels"]
        n = len(f["labels"])
        wanted = len(missing) if n == 0 or math.ceil(len(missing) / n) <= ratio else ratio * n
        assert len(negative) == len(set(negative)) == wanted and set(negative) <= missing
        assert {r.prompt for r in mine if r.kind == "relation" and r.result_list} == f["prompts"]
        related = [r.prompt for r in mine if r.kind == "relation" and not r.result_list]
        pools = [len(f["inverse"]), len(names) - len(f["subjects"]) if f["predicates"] else 0, len(missing) if f["subjects"] else 0]
        n = len(f["prompts"])
        third = ratio // 3
        first = [p if n == 0 or math.ceil(p / n) <= third else third * n for p in pools]
        expected = sum(first) + min(max(n * ratio - sum(first), 0), sum(pools) - sum(first))
        assert len(related) == expected
        for p in related:
            subject, tail = p.split("的", 1)
            from_names = subject in names and subject not in f["subjects"] and tail in f["predicates"]
            from_labels = subject in f["subjects"] and tail in missing
            assert p in f["inverse"] or from_names or from_labels
        aspects = [r for r in mine if r.kind == "aspect"]
        assert len(aspects) == sum("##" in e[1] for e in rows[i][2])


def test_dev_examples(spark, corpus):
    rows, df = corpus
    out = examples.build_extraction_examples(df, "id", -1, options=["好", "壞"], is_train=False).collect()
    facts = {r[0]: facts_of(r) for r in rows}
    predicates = set().union(*[set(f["predicates"]) for f in facts.values()])
    labels = set().union(*[f["labels"] for f in facts.values()])
    for i, f in facts.items():
        related = [r.prompt for r in out if r.id == i and r.kind == "relation" and not r.result_list]
        assert sorted(related) == sorted(f"{s}的{p}" for s in f["subjects"] for p in predicates if f"{s}的{p}" not in f["prompts"])
        assert {r.prompt for r in out if r.id == i and r.kind == "entity" and not r.result_list} == labels - f["labels"]


def test_large_and_small_sets_agree(spark, corpus, monkeypatch):
    _, df = corpus
    small = examples.build_extraction_examples(df, "id", 2).select("id", "kind", "prompt").collect()
    monkeypatch.setattr(negatives, "SMALL_VALUES", 0)
    large = examples.build_extraction_examples(df, "id", 2).select("id", "kind", "prompt").collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))


def test_no_positive_gives_no_example(spark):
    df = spark.createDataFrame([(1, "abc", [], []), (2, "xyz", [], [])], CORPUS)
    assert examples.build_extraction_examples(df, "id").count() == 0


def test_resolve_relations_long(spark):
    e = spark.createDataFrame([(1, 10, "甲", 0, 1), (1, 11, "乙", 2, 3)], "doc_id int, id int, name string, start int, `end` int")
    r = spark.createDataFrame([(1, 10, 11, "父")], "doc_id int, from_id int, to_id int, type string")
    row = examples.resolve_relations(r, e).first()
    assert (row.subject, row.object, row.start) == ("甲", "乙", 2)


def annotated(spark, rows):
    """rows: id, text, results as (id, type, start, end, text, label, from, to)"""
    data = []
    for i, text, results in rows:
        entries = [
            (rid, kind, "label", "text", "manual", (a, b, t, [label], None) if kind == "labels" else None, f, to, [label] if kind == "relation" else None)
            for rid, kind, a, b, t, label, f, to in results
        ]
        data.append((i, (text, None, f"J{i}"), [(1, None, entries)]))
    return spark.createDataFrame(data, ANNOTATED)


def test_annotations_to_corpus(spark):
    df = annotated(
        spark,
        [
            (7, "甲打乙", [("b", "labels", 2, 3, "乙", "人", None, None), ("a", "labels", 0, 1, "甲", "人", None, None), (None, "relation", None, None, None, "打", "a", "b")]),
            (3, "丙", [("a", "labels", 0, 1, "丙", "人", None, None)]),
        ],
    )
    corpus = examples.annotations_to_corpus(df.withColumnRenamed("id", "key"), "key").orderBy("key").collect()
    assert [(r.key, r.id) for r in corpus] == [(3, 1), (7, 2)]
    assert [(e.id, e.start_offset) for e in corpus[1].entities] == [(2, 0), (3, 2)]
    assert [tuple(x) for x in corpus[1].relations] == [(1, 2, 3, "打")]


def test_choices(spark):
    entry = ("r", "choices", "m", "text", "manual", (None, None, None, None, ["好", "新"]), None, None, None)
    df = spark.createDataFrame([(1, ("文", None, "J"), [(1, None, [entry])])], ANNOTATED)
    row = examples.annotation_choices(df).first()
    assert (row.text, row.label) == ("文", ["好", "新"])
    x = examples.classification_examples(examples.annotation_choices(df), "id", options=["好", "新", "舊"]).first()
    assert sorted(s.text for s in x.result_list) == ["好", "新"] and x.content == "文"


def test_split_annotations(spark):
    rows = [(i, "x\n收入 5元", [("a", "labels", 5, 7, "5元", "收入", None, None)]) for i in range(20)]
    out = split_annotations(annotated(spark, rows), clean=True, ratio=[0.8, 0.1, 0.1])
    assert {r["split"]: r["n"] for r in out.groupBy("split").agg(F.countDistinct("id").alias("n")).collect()} == {"train": 16, "dev": 2, "test": 2}
    assert out.count() == 20 * 6
    row = out.where("prompt = '收入'").first()
    assert row.content == "x收入5元" and tuple(row.result_list[0]) == ("5元", 3, 5)
    bad = annotated(spark, [(1, "甲", [(None, "relation", None, None, None, "打", "a", "b")])])
    with pytest.raises(Exception, match="only span labels"):
        split_annotations(bad, ratio=[1, 0, 0]).collect()


def test_split_sizes_and_errors(spark):
    for n in (1, 7, 45, 300):
        df = spark.range(n)
        got = {r["split"]: r["n"] for r in splits.split_extraction(df, "id", [0.8, 0.1, 0.1]).groupBy("split").agg(F.count("*").alias("n")).collect()}
        p1, p2 = round(n * 0.8), round(n * (0.8 + 0.1))
        assert (got.get("train", 0), got.get("dev", 0), got.get("test", 0)) == (p1, p2 - p1, n - p2)
    with pytest.raises(ValueError, match="training split"):
        splits.split_extraction(spark.range(2), "id", [0.1, 0.4, 0.5])
    for ratio in ([0.8, 0.2], [0.5, 0.4, 0.2]):
        with pytest.raises(ValueError):
            splits.split_extraction(spark.range(5), "id", ratio)
    assert splits.split_classification(spark.range(5), "id", []).where("split = 'train'").count() == 5
    again = [splits.split_classification(spark.range(99), "id").orderBy("id").collect() for _ in range(2)]
    assert again[0] == again[1]
    shuffled = [r.id for r in splits.seeded_shuffle(spark.range(50), "id").collect()]
    assert sorted(shuffled) == list(range(50)) != shuffled


def test_split_refines_large_prefixes(spark, monkeypatch):
    expected = sorted(map(tuple, splits.split_classification(spark.range(3000), "id").collect()))
    monkeypatch.setattr(splits, "DIRECT_ORDER", 0)
    assert sorted(map(tuple, splits.split_classification(spark.range(3000), "id").collect())) == expected
    ordered = splits.split_classification(spark.range(3000), "id", [0.5, 0.25, 0.25], shuffle=False)
    assert {r["split"]: (r.a, r.b) for r in ordered.groupBy("split").agg(F.min("id").alias("a"), F.max("id").alias("b")).collect()} == {
        "train": (0, 1499), "dev": (1500, 2249), "test": (2250, 2999)
    }


def test_empty_splits_are_filled(spark):
    df = spark.createDataFrame([(1, "test"), (2, "test")], "id int, split string")
    got = sorted((r["split"], r.id) for r in splits.fill_empty_splits(df).collect())
    assert got == [("dev", 1), ("dev", 2), ("test", 1), ("test", 2), ("train", 1), ("train", 2)]
    df = spark.createDataFrame([(1, "dev")], "id int, split string")
    assert sorted((r["split"], r.id) for r in splits.fill_empty_splits(df).collect()) == [("dev", 1), ("train", 1)]


def test_split_corpus(spark, corpus):
    _, df = corpus
    out = split_corpus(df, "id", [0.5, 0.25, 0.25], negative_ratio=2)
    sizes = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.countDistinct("id").alias("n")).collect()}
    assert set(sizes) == {"train", "dev", "test"}
    assert split_corpus(df, "id").select("split").distinct().collect()[0][0] == "train"


def test_ranks(spark):
    df = spark.range(1000).withColumn("w", F.col("id") % 3)
    rank = [r["rank"] for r in ranks.seeded_rank(df, "id", 1).collect()]
    assert sorted(rank) == list(range(1000))
    total = {r.id: r.before for r in ranks.running_totals(df, "id", {"before": F.col("w")}).collect()}
    run = 0
    for i in range(1000):
        assert total[i] == run
        run += i % 3


# --- merge ----------------------------------------------------------------------------------------


def sides(spark, right_rows):
    left = spark.createDataFrame([("1", "a", None, "x"), ("2", "b", "k", "y"), ("3", "c", None, "z")], "jid string, jyear string, note string, income string")
    right = spark.createDataFrame(right_rows, "jid int, jyear string, note string, pred_labels map<string,int>")
    return left, right


GOOD = [(1, "a", None, {"p": 1, "q": 0}), (2, "b", "k", {"p": 0, "q": 0}), (3, "c", None, {"p": 1, "q": 1})]


def test_merge(spark):
    left, right = sides(spark, GOOD)
    out = merge_tables(left, right, ["p", "q"]).orderBy("jid").collect()
    assert [tuple(r) for r in out] == [(1, "a", None, "x", 1, 0), (2, "b", "k", "y", 0, 0), (3, "c", None, "z", 1, 1)]


def test_merge_errors(spark):
    left, right = sides(spark, GOOD[:1])
    with pytest.raises(ValueError) as e:
        merge_results(left, expand_labels(right, ["p"]))
    assert str(e.value) == "Length of uie result is not equal to length of utc result: 3 != 1. Please check if the inference data is aligned."
    left, right = sides(spark, [(1, "WRONG", None, {}), *GOOD[1:]])
    with pytest.raises(ValueError) as e:
        merge_results(left, expand_labels(right, ["p"]))
    assert str(e.value) == (
        "The length of data has been changed after using pd.merge. Before: 3 != After: 2. "
        "Please check if the data of uie result and utc result are aligned. All values must be the same if on the same column names."
    )
    assert merge_results(left, expand_labels(right, ["p"]), validate=False).count() == 2


def test_hot_keys_are_split(spark):
    """A third of the left rows share one key, another third of the right rows share another."""
    n = 3 * HOT_PARTS
    third = n // 3
    left = spark.range(n).select(F.when(F.col("id") < third, F.lit(-1)).when(F.col("id") == third, F.lit(-2)).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(n).select(
        F.when(F.col("id") == 0, F.lit(-1)).when(F.col("id").between(1, third), F.lit(-2)).otherwise(F.col("id")).alias("k"), F.col("id").alias("b")
    )
    sizes = merge_guard(left, right).first()
    out = merge_results(left, right, validate=False)
    assert sizes.merged_rows == out.count() == third + third + (n - third - 1)
    split = _split_hot_join(left, right, ["k"], key_counts(left, right, ["k"]), sizes.merged_rows)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, out.collect()))
    assert "BroadcastNestedLoopJoin" not in split._jdf.queryExecution().toString()


# --- exports --------------------------------------------------------------------------------------


def test_exports(spark):
    df = spark.createDataFrame(
        [(5, "文", [("收入", 0, 1, 3, "5元", 0.5), ("收入", 1, 4, 5, "x", 0.49)]), (2, "字", [])], f"k int, text string, spans {SPANS}"
    )
    out = export_spans(df, "k", "a@b.c").orderBy("id").collect()
    assert [(r.id, r.data.jfull_compress) for r in out] == [(0, "字"), (1, "文")]
    results = out[1].annotations[0].result
    assert [(r.value.start, r.value.labels) for r in results] == [(1, ["收入"])] and out[1].annotations[0].completed_by.email == "a@b.c"
    assert [r.id for r in export_spans(df, "k", "a@b.c", task_id="k").orderBy("id").collect()] == [2, 5]
    results = spark.createDataFrame([("J1", 9, {"p": 1, "q": 0})], "jid string, id int, pred_labels map<string,int>")
    originals = spark.createDataFrame([("J1", 1, "old"), ("J1", 2, "new")], "jid string, id int, text string")
    row = export_labels(attach_text(results, originals)).first()
    assert row.data.jfull_compress == "new" and row.annotations[0].result[0].value.choices == ["p"]


def test_faulty_relations_get_a_reason(spark):
    """No label, an unknown end, a doubled id: no triple of NULLs, no dead job, no lost negatives."""
    text = "甲在乙住丙"
    entities = [(1, "人", 0, 1), (2, "地", 2, 3), (2, "地", 4, 5)]
    rows = [(1, text, entities, [(1, 1, 2, "住")]), (2, text, entities, [(1, 1, 2, None)]), (3, text, entities, [(1, 1, 9, "住"), (2, 1, 2, "住")])]
    df = spark.createDataFrame(rows, f"k int, text string, entities {ENTITIES}, relations {RELATIONS}")
    out = {r.k: r for r in examples.resolved_relations(examples.named_entities(df)).collect()}
    assert [out[k].reject_reason for k in (1, 2, 3)] == [None, "relation without a label", "relation to an unknown entity"]
    assert [[t.object for t in out[k].triples] for k in (1, 2, 3)] == [["丙"], [], ["丙"]]
    with pytest.raises(Exception, match="relation"):
        examples.resolved_relations(examples.named_entities(df), strict=True).collect()
    built = examples.build_extraction_examples(df, "k", negative_ratio=-1).collect()
    assert all(r.prompt is not None for r in built)
    facts = spark.createDataFrame([(1, ["a", None]), (2, ["b"])], "k int, labels array<string>")
    index = negatives.corpus_indexes(facts, {"labels": F.col("labels")})["labels"]
    got = {(r.k, r.prompt) for r in negatives.entity_negatives(facts, index, "k", -1).collect()}
    assert got == {(1, "b"), (2, "a")}


def test_merge_counts_beyond_a_bigint(spark):
    from spanloom.operators.merge import _totals

    counts = spark.createDataFrame([("x", 4 * 10**9, 4 * 10**9)], "k string, left_rows bigint, right_rows bigint")
    assert _totals(counts).first()["merged_rows"] is None  # more than a BIGINT: never equal to the rows of one side


@pytest.mark.parametrize("direct", [100_000, 0])
def test_splits_in_order_of_any_key(spark, monkeypatch, direct):
    """Negative numbers, strings with long common beginnings and beginnings of each other, dates: as sorted by Python."""
    monkeypatch.setattr(splits, "DIRECT_ORDER", direct)
    day = datetime.date(1969, 12, 20)
    cases = [
        ("bigint", [-(1 << 63), -10, -5, -1, 0, 3, 7, (1 << 63) - 1, 12, 100]),
        ("string", ["", "a", "aa", "ab", "b", "é", "甲", "甲乙", "𠀀", "Z"]),
        ("string", [f"a very long common beginning {n:03d}" for n in range(40)]),
        ("date", [day + datetime.timedelta(days=n) for n in range(20)]),
    ]
    for kind, keys in cases:
        df = spark.createDataFrame([(k,) for k in keys][::-1], f"`the key` {kind}")
        got = {r[0]: r[1] for r in splits.split_classification(df, "the key", [0.5, 0.3, 0.2], shuffle=False).collect()}
        ordered = sorted(keys, key=lambda k: k.encode() if isinstance(k, str) else k)
        p1, p2 = int(len(keys) * 0.5), int(len(keys) * 0.8)
        assert got == {k: "train" if i < p1 else "dev" if i < p2 else "test" for i, k in enumerate(ordered)}
    for bad in ([("a",), (None,)],):
        for shuffle in (True, False):
            with pytest.raises(Exception, match="needs a key"):
                splits.split_classification(spark.createDataFrame(bad, "k string"), "k", [0.5, 0.3, 0.2], shuffle=shuffle).collect()
    with pytest.raises(ValueError, match="no order of digits"):
        splits.split_classification(spark.createDataFrame([(0.5,)], "k double"), "k", [0.5, 0.3, 0.2], shuffle=False)


def test_one_scan_of_the_input_for_a_split(spark, tmp_path, monkeypatch):
    """All counts and cuts read the table of keys; the input is read for it and for the result."""
    monkeypatch.setattr(splits, "DIRECT_ORDER", 2)
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    df = spark.range(500).mapInArrow(seen, "id bigint")
    rows = splits.split_extraction(df, "id", [0.5, 0.3, 0.2]).groupBy("split").count().collect()
    assert {r[0]: r[1] for r in rows} == {"train": 250, "dev": 150, "test": 100} and counted.value == 1000


def test_permutation_of_a_document(spark):
    """Every value is drawn once, in an order of the document's own; the row is never exchanged."""
    assert [negatives.prime_from(n) for n in (0, 2, 8, 9, 14, 90)] == [2, 2, 11, 11, 17, 97]
    facts = spark.createDataFrame([(k, [f"v{k}", "v3", None]) for k in range(12)], "k int, labels array<string>")
    index = negatives.corpus_indexes(facts, {"labels": F.col("labels")}, 5)["labels"]
    assert index.size == 12 and index.frame is None
    frame = negatives.entity_negatives(facts, index, "k", -1, 5)
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in frame.collect():
        got.setdefault(r.k, []).append(r.prompt)
    assert all(sorted(got[k]) == sorted({f"v{n}" for n in range(12)} - {f"v{k}", "v3"}) for k in range(12))
    assert len({tuple(v) for v in got.values()}) == 12
    few = negatives.entity_negatives(facts, index, "k", 2, 5).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in few} == {k: 2 if k == 3 else 4 for k in range(12)}
