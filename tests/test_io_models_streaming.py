import glob
import json

import pytest
from pyspark.sql import functions as F

from spanloom.functions.rules import Rule, default_rules, rule_spans
from spanloom.functions.text import clean_text
from spanloom.operators import scoring
from spanloom.operators.chunk import chunk_examples
from spanloom.operators.examples import annotation_spans, prompt_examples, standard_label_examples
from spanloom.operators.regularize import regularize_annotations
from spanloom.operators.shrink import shrink_documents
from spanloom.operators.spans import as_entity_map, fill_missing, from_entity_map
from spanloom.operators.validate import validate_label_examples, validate_prompt_examples
from spanloom.plans.classification import classify_documents
from spanloom.plans.extraction import extract_to_table
from spanloom.schemas import PLAIN_SPANS, SCORED_SPANS, SPANS
from spanloom.session import durable, shared_folder
from spanloom.sources import readers, writers


def put(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf8")
    return str(path)


EXPORT = {
    "id": 3,
    "data": {"jfull_compress": "賠償110元", "jid": "J3"},
    "annotations": [{"id": 1, "completed_by": {"id": 1}, "result": [{"id": "a", "type": "labels", "value": {"start": 2, "end": 6, "text": "110元", "labels": ["醫療費"]}}]}],
    "predictions": [],
}


def test_annotation_files(spark, tmp_path):
    single = readers.read_annotations(spark, put(tmp_path / "one.json", EXPORT))
    many = readers.read_annotations(spark, put(tmp_path / "many.json", [EXPORT, {**EXPORT, "id": 4}]))
    assert (single.count(), many.count()) == (1, 2)
    docs = annotation_spans(single).select("id", F.col("data.jfull_compress").alias("text"), "spans")
    row = prompt_examples(docs, ["收入", "醫療費"]).where("prompt = '醫療費'").first()
    assert tuple(row.result_list[0]) == ("110元", 2, 6)
    with pytest.raises(ValueError, match="Data not found in file"):
        readers.read_annotations(spark, put(tmp_path / "empty.json", ""))


def test_regularized_annotations_round_trip(spark, tmp_path):
    results = [
        {"id": "b", "type": "labels", "value": {"start": 9, "end": 13, "text": "1\n0元", "labels": ["收入"]}},
        {"id": "a", "type": "labels", "value": {"start": 3, "end": 7, "text": "11 元", "labels": ["醫療費"]}},
        {"id": "r", "type": "relation", "from_id": "a", "to_id": "b", "labels": ["和"]},
    ]
    dirty = {**EXPORT, "data": {"jfull_compress": "賠\n償11 元　\n1\n0元", "jid": "J"}, "annotations": [{"id": 1, "result": results}]}
    df = readers.read_annotations(spark, put(tmp_path / "dirty.json", [dirty, EXPORT]))
    fixed = regularize_annotations(df, strict=True).drop("reject_reason")
    writers.write_json(fixed, str(tmp_path / "clean"))
    rows = readers.read_annotations(spark, str(tmp_path / "clean"), lines=True).orderBy("data.jid").collect()
    first = rows[0].annotations[0].result
    assert rows[0].data.jfull_compress == "賠償11元10元"
    assert [(r.id, r.value.start, r.value.end, r.value.text) for r in first[:2]] == [("a", 2, 5, "11元"), ("b", 5, 8, "10元")]
    assert first[2].type == "relation" and first[2].from_id == "a"
    assert rows[1].annotations[0].result[0].value.text == "110元"
    bad = {**dirty, "annotations": [{"id": 1, "result": [{**results[0], "value": {**results[0]["value"], "end": 12}}]}]}
    with pytest.raises(Exception, match="slice differs"):
        regularize_annotations(readers.read_annotations(spark, put(tmp_path / "bad.json", bad)), strict=True).collect()


def test_documents(spark, tmp_path):
    verdicts = [{"jid": "J1", "jyear": "110", "jfull_compress": "文一", "extra": 1}, {"jid": "J2", "jyear": "111", "jfull_compress": "文二", "extra": 2}]
    df = readers.read_documents(spark, put(tmp_path / "d.json", verdicts))
    assert df.count() == 2 and "extra" in df.columns
    typed = readers.read_documents(spark, str(tmp_path / "d.json"), schema=readers.verdict_schema())
    assert typed.first().jid == "J1" and "source_cnt_v2" in typed.columns
    lines = readers.read_documents(spark, put(tmp_path / "d.txt", " 甲 \n　乙\t\n"))
    assert sorted(r.jfull_compress for r in lines.collect()) == ["乙", "甲"]
    with pytest.raises(ValueError, match="read from .txt or .json files"):
        readers.read_documents(spark, str(tmp_path / "d.csv"))
    assert readers.documents_from_list(spark, ["a", "b"]).count() == 2


def test_prompt_and_label_examples(spark, tmp_path):
    row = {"content": "賠償110元", "result_list": [{"text": "110元", "start": 2, "end": 6}], "prompt": "醫療費"}
    df = readers.read_prompt_examples(spark, put(tmp_path / "p.txt", json.dumps(row, ensure_ascii=False) + "\n" + json.dumps({**row, "prompt": "x"}) + "\n"))
    reasons = [r.reject_reason for r in validate_prompt_examples(df, ["醫療費"]).collect()]
    assert sorted(reasons, key=str) == [None, "unknown prompt"]
    with pytest.raises(Exception, match="unknown prompt"):
        validate_prompt_examples(df, ["醫療費"], strict=True).select("content").collect()
    folder = tmp_path / "labels"
    folder.mkdir()
    a = {"text_a": "abc", "text_b": "", "question": "", "choices": ["x", "y"], "labels": [1]}
    put(folder / "my_train.txt", json.dumps(a) + "\n" + json.dumps({**a, "labels": 0}) + "\n")
    put(folder / "dev.txt", json.dumps(a) + "\n")
    train = readers.read_label_examples(spark, str(folder), "train.txt")
    assert train.count() == 2 and readers.read_label_examples(spark, str(folder)).count() == 3
    validate_label_examples(train)
    with pytest.raises(ValueError):
        validate_label_examples(train.drop("question"))
    assert sorted(r.labels for r in standard_label_examples(train).collect()) == [[0.0, 1.0], [1.0, 0.0]]
    both = readers.read_splits(spark, {"train": str(folder / "my_train.txt"), "dev": str(folder / "dev.txt")})
    assert both.where("split = 'dev'").count() == 1
    assert readers.label_list(spark, put(tmp_path / "l.txt", "乙\n 甲 \n丙\n")) == ["乙", "甲", "丙"]


def test_corpus_layouts(spark, tmp_path):
    entity = [{"id": 5, "label": "人", "start_offset": 0, "end_offset": 1}, {"id": 9, "label": "人", "start_offset": 2, "end_offset": 3}]
    relation = [{"id": 0, "from_id": 5, "to_id": 9, "type": "打"}]
    rows = [
        {"data": "甲打乙", "label": [[0, 1, "人"], [2, 3, "人"]]},
        {"data": "甲打乙", "label": {"entities": entity, "relations": relation}},
        {"text": "甲打乙", "label": [[0, 1, "人"], [2, 3, "人"]]},
        {"text": "甲打乙", "entities": entity, "relations": relation},
        {"data": "甲打乙", "label": {"entities": entity}},
    ]
    df = readers.read_corpus_export(spark, put(tmp_path / "c.json", "\n".join(json.dumps(r, ensure_ascii=False) for r in rows)))
    out = df.coalesce(1).collect()
    assert [r.text for r in out] == ["甲打乙"] * 5
    assert [[e.id for e in r.entities] for r in out] == [[0, 1], [5, 9], [0, 1], [5, 9], [5, 9]]
    assert [len(r.relations) for r in out] == [0, 1, 0, 1, 0]
    assert out[1].relations[0].type == "打" and out[0].entities[1].start_offset == 2


def test_results_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("J1", "文", [("收入", 0, 1, 3, "5元", 0.5)])], f"jid string, jfull_compress string, spans {SPANS}")
    writers.write_json(df.select("jid", "jfull_compress", as_entity_map(F.col("spans")).alias("InferenceResults")), str(tmp_path / "r"))
    schema = f"jid STRING, jfull_compress STRING, InferenceResults ARRAY<MAP<STRING, {SCORED_SPANS}>>"
    back = readers.read_results(spark, str(tmp_path / "r"), schema, lines=True)
    assert back.select(from_entity_map(F.col("InferenceResults")).alias("spans")).first().spans == df.first().spans
    assert any("收入" in open(f, encoding="utf8").read() for f in glob.glob(str(tmp_path / "r" / "part*")))


def test_csv_and_splits(spark, tmp_path):
    df = spark.createDataFrame([("J1", 'a "q"\nb, c', 1)], "jid string, text string, n int")
    writers.write_csv(df.coalesce(1), str(tmp_path / "c"), ["jid", "text"], bom=True)
    raw = open(glob.glob(str(tmp_path / "c" / "part*"))[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfjid,text")
    back = readers.read_flat_table(spark, str(tmp_path / "c"))
    assert back.columns == ["jid", "text"] and tuple(back.first()) == ("J1", 'a "q"\nb, c')
    parts = spark.createDataFrame([(1, "train"), (2, "dev")], "id int, split string")
    writers.write_splits(parts, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s" / "split=dev")).first().id == 2
    writers.write_documents(parts.drop("split"), str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 2


def test_durable(spark):
    df = durable(spark.range(5).withColumn("x", F.array("id")))
    assert df.count() == 5 and shared_folder(spark)


# --- models ---------------------------------------------------------------------------------------


def test_user_hooks(spark):
    def make_span_scorer():
        def score(text):
            at = text.find("乙")
            return [] if at < 0 else [{"entity": "人", "start": at, "end": at + 1, "text": "乙", "probability": 0.8}]

        return score

    df = spark.createDataFrame([(1, "甲 乙"), (2, "丙")], "id int, text string")
    out = scoring.infer_spans(df, make_scorer=make_span_scorer, preprocess=clean_text, postprocess=lambda d: fill_missing(d, ["人"])).orderBy("id").collect()
    assert [(s.start, s.text) for r in out for s in r.spans] == [(1, "乙"), (-1, "nan")]
    flat = extract_to_table(df, ["人"], {"人": Rule("甲|乙")}, clean=True, strategy="max").orderBy("id").collect()
    assert [r["人"] for r in flat] == ["甲", "nan"]
    money = extract_to_table(spark.createDataFrame([(1, "賠償五萬元")], "id int, text string"), ["醫療費"], {"醫療費": Rule("五萬元")}, money=["醫療費"])
    assert money.first()["醫療費"] == "50000"


def test_two_stages(spark):
    def make_label_scorer():
        return lambda texts: [[float("乙" in t) * 2 - 1, 1.0] for t in texts]

    df = spark.createDataFrame([("J1", "甲" * 90 + "受有傷害乙" + "甲" * 90), ("J2", "丙" * 50)], "jid string, text string")
    rules = default_rules(["年齡", "肇責", "受有傷害"])
    out = classify_documents(df, ["有乙", "總是"], rules, max_seq_len=60, make_label_scorer=make_label_scorer).orderBy("jid").collect()
    assert out[0].pred_labels == {"有乙": 1, "總是": 1} and out[1].pred_labels == {"有乙": 0, "總是": 1}
    assert len(out[0].text) <= 60
    with pytest.raises(ValueError):
        scoring.score_labels(df, ["a"])


def test_row_local_operators_run_on_a_stream(spark, tmp_path):
    """The same column functions on a streaming frame; nothing in them keeps state."""
    source, sink = tmp_path / "in", tmp_path / "out"
    rows = [(1, "甲 受有傷害 乙"), (2, "出生")]
    spark.createDataFrame(rows, "id int, text string").write.json(str(source))
    stream = spark.readStream.schema("id int, text string").json(str(source))
    rules = default_rules(["年齡", "肇責", "受有傷害"])

    def job(df):
        df = df.withColumn("text", clean_text(F.col("text"))).withColumn("spans", rule_spans(F.col("text"), rules))
        short = shrink_documents(df, 6)
        plain = F.transform(F.filter("spans", lambda s: F.lit(False)), lambda s: F.struct(s["text"], s["start"], s["end"])).cast(PLAIN_SPANS)
        return chunk_examples(short.select("id", F.col("text").alias("content"), F.lit("p").alias("prompt"), plain.alias("result_list")), 8)

    query = job(stream).writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    batch = job(spark.createDataFrame(rows, "id int, text string"))
    assert sorted(map(str, spark.read.parquet(str(sink)).select(batch.columns).collect())) == sorted(map(str, batch.collect()))
