"""Jobs over files: splits, guards and what they write."""

import json

import pytest
from pyspark.sql import functions as F

from spanloom.functions.rules import Rule
from spanloom.plans import jobs
from spanloom.sources import readers


def annotations(path, rows):
    """rows: id, text, results"""
    data = [{"id": i, "data": {"jfull_compress": t}, "annotations": [{"id": i, "result": r}]} for i, t, r in rows]
    path.write_text(json.dumps(data, ensure_ascii=False))
    return str(path)


def choice(*labels):
    return [{"id": "r", "type": "choices", "value": {"choices": list(labels)}}]


def vocabulary(path, labels):
    path.write_text("\n".join(f" {x} " for x in labels) + "\n")
    return str(path)


def split_rows(spark, out, split, columns):
    return sorted(tuple(r) for r in spark.read.json(f"{out}/split={split}").select(*columns).collect())


def test_label_preparation(spark, tmp_path):
    rows = [(i, f"甲{i}\t乙\t丙{i}", choice("好", "壞") if i % 2 else []) for i in range(10)]
    labels = vocabulary(tmp_path / "labels.txt", ["新", "好", "壞"])
    jobs.prepare_labels(spark, annotations(tmp_path / "a.json", rows), labels, f"{tmp_path}/out", [0.6, 0.2, 0.2], shuffle=False, separator="\t")
    got = {s: split_rows(spark, f"{tmp_path}/out", s, ["text_a", "text_b", "labels", "choices"]) for s in ("train", "dev", "test")}
    assert {s: len(v) for s, v in got.items()} == {"train": 6, "dev": 2, "test": 2}
    assert got["train"][1] == ("甲1乙", "丙1", [1, 2], ["新", "好", "壞"]) and got["dev"][0] == ("甲6乙", "丙6", [], ["新", "好", "壞"])


def test_empty_splits_take_rows_of_others(spark, tmp_path):
    source, labels = annotations(tmp_path / "a.json", [(i, f"t{i}", choice("x")) for i in range(4)]), vocabulary(tmp_path / "labels.txt", ["x"])
    for ratio, sizes in (([0.0, 0.0, 1.0], (4, 4, 4)), ([0.0, 1.0, 0.0], (4, 4, 0)), ([0.5, 0.0, 0.5], (2, 2, 2))):
        out = f"{tmp_path}/out-{sizes[0]}-{sizes[2]}"
        jobs.prepare_labels(spark, source, labels, out, ratio, lines=False)
        back = spark.read.schema("text_a string, split string").json(out).groupBy("split").count().collect()
        assert tuple({r["split"]: r["count"] for r in back}.get(s, 0) for s in ("train", "dev", "test")) == sizes


def test_a_label_beyond_the_vocabulary_stops(spark, tmp_path):
    source = annotations(tmp_path / "a.json", [(1, "t", choice("x", "y"))])
    with pytest.raises(Exception, match="label not in vocabulary: y"):
        jobs.prepare_labels(spark, source, vocabulary(tmp_path / "labels.txt", ["x"]), f"{tmp_path}/out", [1.0, 0.0, 0.0])


def test_classes_of_documents(spark, tmp_path):
    source = annotations(tmp_path / "a.json", [(i, f"text {i}", choice("pos")) for i in range(8)])
    with pytest.raises(ValueError, match="ext or cls"):
        jobs.prepare_corpus(spark, source, f"{tmp_path}/x", "other")
    jobs.prepare_corpus(spark, source, f"{tmp_path}/out", "cls", [0.5, 0.25, 0.25], prefix="mood", options=["pos", "neg"])
    rows = {s: split_rows(spark, f"{tmp_path}/out", s, ["content", "prompt", "result_list"]) for s in ("train", "dev", "test")}
    assert [len(rows[s]) for s in ("train", "dev", "test")] == [4, 2, 2]
    for content, prompt, spans in [r for v in rows.values() for r in v]:
        assert sorted(prompt[5:-1].split(",")) == ["neg", "pos"] and prompt.startswith("mood[") and [s.text for s in spans] == ["pos"]
        # Offsets count backwards from the content: prompt, one separator, content.
        assert f"{prompt} {content}"[len(prompt) + 1 + spans[0].start : len(prompt) + 1 + spans[0].end] == "pos"


def test_training_examples_come_in_random_order(spark, tmp_path):
    entity = lambda a, b, t: {"id": f"{a}", "type": "labels", "value": {"start": a, "end": b, "text": t, "labels": ["人"]}}
    source = annotations(tmp_path / "a.json", [(i, f"甲乙{i}", [entity(0, 1, "甲")]) for i in range(20)])
    for seed, folder in ((1, "a"), (1, "b"), (2, "c")):
        jobs.prepare_corpus(spark, source, f"{tmp_path}/{folder}", "ext", seed=seed)
    orders = [[r["content"] for r in spark.read.json(f"{tmp_path}/{f}/split=train").collect()] for f in "abc"]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2]) == sorted(f"甲乙{i}" for i in range(20))


def test_span_evaluation(spark, tmp_path):
    rows = [{"content": "a1 b22 a3", "prompt": p, "result_list": [{"text": t, "start": s, "end": e} for t, s, e in spans]} for p, spans in (("a", [("a1", 0, 2), ("a3", 7, 9)]), ("b", [("b22", 3, 6)]))]
    (tmp_path / "dev.txt").write_text("\n".join(json.dumps(r) for r in rows))
    predict = jobs.rule_predictions({"a": Rule("a[0-9]"), "b": Rule("b[0-9]")})
    jobs.evaluate_spans(spark, f"{tmp_path}/dev.txt", predict, f"{tmp_path}/m", 64, by_class=True, classes=["a", "b"])
    got = {r["entity"]: (r["correct"], r["predicted"], r["gold"]) for r in spark.read.json(f"{tmp_path}/m").collect()}
    assert got == {"a": (2, 2, 2), "b": (0, 1, 1), "total": (2, 3, 3)}
    jobs.evaluate_spans(spark, f"{tmp_path}/dev.txt", predict, f"{tmp_path}/t", 64)
    assert [r["f1"] for r in spark.read.json(f"{tmp_path}/t").collect()] == [0.666667]
    with pytest.raises(Exception, match="Unknown entity: b"):
        jobs.evaluate_spans(spark, f"{tmp_path}/dev.txt", predict, f"{tmp_path}/u", 64, by_class=True, classes=["a"])


def test_label_evaluation(spark, tmp_path):
    rows = spark.createDataFrame([(1, [3.0, -3.0], [1, 0]), (2, [3.0, 3.0], [1, 0])], "id int, logits array<double>, labels array<int>")
    jobs.evaluate_labels(rows, f"{tmp_path}/out", 2)
    predictions = {r["id"]: r["labels"] for r in spark.read.json(f"{tmp_path}/out/predictions").collect()}
    metrics = spark.read.json(f"{tmp_path}/out/metrics").first()
    assert predictions == {1: [0], 2: [0, 1]} and (metrics["accuracy"], metrics["precision"], metrics["recall"]) == (0.5, 0.666667, 1.0)


def test_merge_of_files(spark, tmp_path):
    (tmp_path / "table.csv").write_text("\ufeffjid,text\nJ1,\"a \"\"b\"\"\"\nJ2,c\n")
    right = [{"jid": "J1", "pred_labels": {"x": 1, "y": 0}}, {"jid": "J2", "pred_labels": {"x": 0, "y": 1}}]
    (tmp_path / "r.json").write_text(json.dumps(right))
    schema = "jid STRING, pred_labels MAP<STRING, BIGINT>"
    jobs.merge_files(spark, f"{tmp_path}/table.csv", f"{tmp_path}/r.json", f"{tmp_path}/out", ["x", "y"], schema)
    back = readers.read_flat_table(spark, f"{tmp_path}/out").orderBy("jid").collect()
    assert [tuple(r) for r in back] == [("J1", 'a "b"', "1", "0"), ("J2", "c", "0", "1")]
    for wrong, reason in ((right[:1], "(?i)length|rows"), ([right[0], {"jid": "J9", "pred_labels": {"x": 0, "y": 0}}], "(?i)length|rows")):
        (tmp_path / "r.json").write_text(json.dumps(wrong))
        with pytest.raises(ValueError, match=reason):
            jobs.merge_files(spark, f"{tmp_path}/table.csv", f"{tmp_path}/r.json", f"{tmp_path}/never", ["x", "y"], schema)
    assert not (tmp_path / "never").exists()


def test_shuffled_names_rows_by_columns(spark):
    df = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").cast("string").alias("p"))
    once = [tuple(r) for r in jobs.shuffled(df, ["k", "p"], 3).collect()]
    assert once == [tuple(r) for r in jobs.shuffled(df.repartition(7), ["k", "p"], 3).collect()] and once != sorted(once)
