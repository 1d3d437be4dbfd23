"""Queries that write the layouts of the outside world, run the jobs and readers over them, and return what comes back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import Rule
from ..operators import shrink, splits
from ..operators import spans as span_ops
from ..operators.examples import prompt_examples
from ..operators.regularize import regularize_annotations
from ..operators.validate import accepted, validate_prompt_examples
from ..session import shared_folder
from ..sources import readers, writers
from . import jobs
from .queries import (
    BUDGET, ENTITY_NAMES, LABELS, N_DIMS, NUMBER_LINE, RULES, _labelled, _logits, _merge_sides, _overlapping, customer_corpus, digest, documents, show_spans, stand_in_probability, table,
    wide_ints, with_spans,
)

RATIO = [0.8, 0.1, 0.1]
LINE_RULES = {**RULES, "line": Rule(first=NUMBER_LINE)}
LOOSER = {**RULES, "card": Rule(r"[0-9]{12,16}"), "email": Rule(r"(?<![A-Za-z0-9.])[A-Za-z0-9.]+@[A-Za-z0-9.]+")}


def folder_for(spark: SparkSession) -> str:
    """A new folder that all executors reach."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def span_layout(df: DataFrame) -> DataFrame:
    """Documents with spans as exports of the annotation tool."""
    result = F.transform(
        "spans",
        lambda s, i: F.struct(
            i.cast("string").alias("id"), F.lit("labels").alias("type"),
            F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), F.array(s["entity"]).alias("labels")).alias("value"),
        ),
    )
    return df.select(F.col("doc_id").alias("id"), F.struct(F.col("text").alias("jfull_compress")).alias("data"), F.array(F.struct(result.alias("result"))).alias("annotations"))


def choice_layout(df: DataFrame, choices: str) -> DataFrame:
    """Documents with chosen classes in the same layout."""
    result = F.array(F.struct(F.lit("r").alias("id"), F.lit("choices").alias("type"), F.struct(F.col(choices).alias("choices")).alias("value")))
    return df.select(F.col("doc_id").alias("id"), F.struct(F.col("text").alias("jfull_compress")).alias("data"), F.array(F.struct(result.alias("result"))).alias("annotations"))


def files_annotations(spark, folder):
    """Annotation files, regularised and written again."""
    out = folder_for(spark)
    writers.write_json(span_layout(with_spans(documents(spark, folder), LINE_RULES)), f"{out}/in")
    done = regularize_annotations(readers.read_annotations(spark, f"{out}/in", lines=True))
    writers.write_json(accepted(done), f"{out}/regular")
    result = F.col("annotations")[0]["result"]
    shown = F.array_join(F.transform(result, lambda r: F.concat_ws(":", r["value"]["labels"][0], r["value"]["start"].cast("string"), r["value"]["end"].cast("string"), r["value"]["text"])), "|")
    back = readers.read_annotations(spark, f"{out}/regular", lines=True)
    return wide_ints(back.select(F.col("id").alias("doc_id"), digest(F.col("data.jfull_compress")).alias("text_md5"), F.size(result).cast("bigint").alias("n_spans"), shown.alias("spans")))


def files_verdicts(spark, folder):
    """Verdict files with the fixed schema; keys beyond it are left out."""
    out = f"{folder_for(spark)}/verdicts.json"
    docs = table(spark, folder, "documents")
    writers.write_json(docs.select(F.col("doc_id").cast("string").alias("jid"), F.col("lang").alias("jtitle"), F.col("text").alias("jfull_compress"), F.col("n_chars").alias("beyond")), out)
    back = readers.read_documents(spark, out, lines=True, schema=readers.verdict_schema())
    return wide_ints(back.select("jid", "jtitle", digest(F.col("jfull_compress")).alias("text_md5"), F.length("jfull_compress").alias("n_chars")))


def files_text_lines(spark, folder):
    """One document a line, without white space at its ends."""
    out = f"{folder_for(spark)}/lines.txt"
    documents(spark, folder).select(F.translate("text", "\n\r", "  ").alias("value")).write.text(out)
    back = readers.read_documents(spark, out, text="line")
    return back.groupBy(digest(F.col("line")).alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


def files_prompt_splits(spark, folder):
    """Prompt examples of each split, written, read as one frame and checked."""
    out = folder_for(spark)
    docs = splits.split_extraction(with_spans(documents(spark, folder)), "doc_id", RATIO, 1000)
    writers.write_splits(prompt_examples(docs, ENTITY_NAMES).select("content", "result_list", "prompt", "split"), out)
    back = readers.read_splits(spark, {s: f"{out}/split={s}" for s in splits.SPLITS}, readers.read_prompt_examples)
    checked = validate_prompt_examples(back, ENTITY_NAMES)
    return checked.select("split", "prompt", digest(F.col("content")).alias("content_md5"), show_spans(F.col("result_list"), "start", "end", "text").alias("result"), F.col("reject_reason").alias("reason"))


def _label_files(spark, folder, ratio):
    out = folder_for(spark)
    writers.write_json(choice_layout(_labelled(spark, folder), "choices"), f"{out}/in")
    spark.createDataFrame([(" " + "\n ".join(LABELS),)], "value string").coalesce(1).write.text(f"{out}/labels.txt")
    jobs.prepare_labels(spark, f"{out}/in", f"{out}/labels.txt", f"{out}/out", ratio, 11, separator="\n", lines=True)
    return readers.read_splits(spark, {s: f"{out}/out/split={s}" for s in splits.SPLITS}, lambda s, path: readers.read_label_examples(s, path, ".json"))


def files_label_job(spark, folder):
    """The label data preparation job, from annotation files to split files."""
    back = _label_files(spark, folder, [0.7, 0.2, 0.1])
    return back.select(
        "split", digest(F.col("text_a")).alias("a_md5"), digest(F.col("text_b")).alias("b_md5"), "question", F.array_join("choices", ",").alias("choices"),
        F.translate("labels", "[] ", "").alias("labels"),
    )


def files_label_job_one_split(spark, folder):
    """The same with nothing but test documents: train and dev take their rows."""
    back = _label_files(spark, folder, [0.0, 0.0, 1.0])
    chars = F.length("text_a") + F.length("text_b")
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(chars).alias("chars"))


def files_choice_job(spark, folder):
    """The corpus job for chosen classes."""
    out = folder_for(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", F.array("lang").alias("langs"))
    writers.write_json(choice_layout(docs, "langs"), f"{out}/in")
    jobs.prepare_corpus(spark, f"{out}/in", f"{out}/out", "cls", [0.5, 0.3, 0.2], seed=7, prefix="language", options=["en", "fr", "de", "es"], lines=True)
    back = readers.read_splits(spark, {s: f"{out}/out/split={s}" for s in splits.SPLITS}, readers.read_prompt_examples)
    return back.select("split", digest(F.col("content")).alias("content_md5"), "prompt", show_spans(F.col("result_list"), "text", "start", "end").alias("result"))


def files_flat_table(spark, folder):
    """The flat table as CSV with a byte order mark."""
    out = folder_for(spark)
    flat = span_ops.flat_entity_table(with_spans(documents(spark, folder)), ENTITY_NAMES, ["text", "start", "end", "probability"])
    writers.write_csv(flat, out, bom=True)
    back = readers.read_flat_table(spark, out)
    kinds = {f.name: f.dataType for f in flat.schema}
    return wide_ints(back.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in back.columns]))


def files_merge_job(spark, folder):
    """The merge job: CSV and JSON to CSV."""
    out = folder_for(spark)
    left, right = _merge_sides(spark, folder)
    writers.write_csv(left, f"{out}/table")
    writers.write_json(right, f"{out}/results")
    schema = "jid BIGINT, kind STRING, nation BIGINT, pred_labels MAP<STRING, BIGINT>"
    jobs.merge_files(spark, f"{out}/table", f"{out}/results", f"{out}/merged", ["good", "big"], schema, lines=True)
    back = readers.read_flat_table(spark, f"{out}/merged")
    return back.select(*[F.col(c).cast("bigint").alias(c) if c in ("jid", "nation", "good", "big") else F.col(c) for c in back.columns])


def files_corpus_layouts(spark, folder):
    """Four layouts of corpus exports in one folder, read as one."""
    out = folder_for(spark)
    docs = customer_corpus(spark, folder).select(F.col("doc_id").alias("id"), "text", "entities", "relations")
    ends = lambda e: F.array(e["start_offset"].cast("string"), e["end_offset"].cast("string"), e["label"])
    pairs = F.transform("entities", lambda e: F.concat(F.lit("["), F.array_join(F.slice(ends(e), 1, 2), ","), F.lit(', "'), e["label"], F.lit('"]')))
    both = F.struct("entities", "relations")
    layouts = [
        docs.where("id % 4 = 0").select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "data": '), F.to_json(F.array("text")).substr(F.lit(2), F.length(F.to_json(F.array("text"))) - 2), F.lit(', "label": ['), F.array_join(pairs, ", "), F.lit("]}")).alias("value")),
        docs.where("id % 4 = 1").select(F.to_json(F.struct("id", F.col("text").alias("data"), both.alias("label"))).alias("value")),
        docs.where("id % 4 = 2").select(F.to_json(F.struct("id", "text", both.alias("label"))).alias("value")),
        docs.where("id % 4 = 3").select(F.to_json(F.struct("id", "text", "entities", "relations")).alias("value")),
    ]
    for n, layout in enumerate(layouts):
        layout.write.text(f"{out}/layout-{n}")
    back = readers.read_corpus_export(spark, [f"{out}/layout-{n}" for n in range(4)])
    return back.select(
        F.col("id").alias("doc_id"), digest(F.col("text")).alias("text_md5"), show_spans(F.col("entities"), "id", "label", "start_offset", "end_offset").alias("entities"),
        show_spans(F.col("relations"), "id", "from_id", "to_id", "type").alias("relations"),
    )


def files_extraction_job(spark, folder):
    """The corpus job for spans and relations, from annotation files, all into train."""
    out = folder_for(spark)
    docs = customer_corpus(spark, folder)
    value = F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("array<string>").alias("labels"))
    spans = F.transform(
        "entities",
        lambda e: F.struct(
            e["id"].cast("string").alias("id"), F.lit("labels").alias("type"), F.struct(e["start_offset"].alias("start"), e["end_offset"].alias("end"), F.array(e["label"]).alias("labels")).alias("value"),
            F.lit(None).cast("string").alias("from_id"), F.lit(None).cast("string").alias("to_id"), F.lit(None).cast("array<string>").alias("labels"),
        ),
    )
    links = F.transform(
        "relations",
        lambda r: F.struct(
            F.lit(None).cast("string").alias("id"), F.lit("relation").alias("type"), value.alias("value"), r["from_id"].cast("string").alias("from_id"), r["to_id"].cast("string").alias("to_id"),
            F.array(r["type"]).alias("labels"),
        ),
    )
    layout = docs.select(F.col("doc_id").alias("id"), F.struct(F.col("text").alias("jfull_compress")).alias("data"), F.array(F.struct(F.concat(spans, links).alias("result"))).alias("annotations"))
    writers.write_json(layout, f"{out}/in")
    jobs.prepare_corpus(spark, f"{out}/in", f"{out}/out", "ext", (), 5, seed=7, options=["rich", "poor", "late"], lines=True)
    back = spark.read.schema("content STRING, result_list ARRAY<STRUCT<text: STRING, `start`: INT, `end`: INT>>, prompt STRING, kind STRING").json(f"{out}/out/split=train")
    return back.select(F.lit("train").alias("split"), "kind", digest(F.col("content")).alias("content_md5"), "prompt", show_spans(F.col("result_list"), "text", "start", "end").alias("result"))


def files_span_evaluation(spark, folder):
    """Evaluation by class: prompt examples from files, a looser predictor, metrics to JSON and back."""
    out = folder_for(spark)
    writers.write_json(prompt_examples(with_spans(documents(spark, folder)), ENTITY_NAMES).select("content", "result_list", "prompt"), f"{out}/in")
    predict = jobs.rule_predictions(LOOSER, stand_in_probability, 0.1)
    jobs.evaluate_spans(spark, f"{out}/in", predict, f"{out}/metrics", 1 << 30, by_class=True, classes=ENTITY_NAMES)
    schema = "entity STRING, correct BIGINT, predicted BIGINT, gold BIGINT, precision DOUBLE, recall DOUBLE, f1 DOUBLE"
    return spark.read.schema(schema).json(f"{out}/metrics")


def files_label_predictions(spark, folder):
    """Label evaluation: the predictions file."""
    out = folder_for(spark)
    jobs.evaluate_labels(_logits(spark, folder), out, N_DIMS, key="vec_id")
    back = spark.read.schema("id BIGINT, labels ARRAY<BIGINT>, probs ARRAY<DOUBLE>").json(f"{out}/predictions")
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    return back.select("id", F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"), F.round(total, 6).alias("prob_sum"))


def files_label_metrics(spark, folder):
    """Label evaluation: the metrics file."""
    out = folder_for(spark)
    jobs.evaluate_labels(_logits(spark, folder), out, N_DIMS, key="vec_id")
    return spark.read.schema("micro_f1 DOUBLE, macro_f1 DOUBLE, accuracy DOUBLE, precision DOUBLE, recall DOUBLE").json(f"{out}/metrics")


def files_shortened(spark, folder):
    """Shortened documents of each split, in the layout they came in."""
    out = folder_for(spark)
    docs = splits.split_extraction(_overlapping(spark, folder), "doc_id", RATIO, 1000)
    short = shrink.shrink_documents(docs, BUDGET).select("doc_id", "text", "split")
    writers.write_documents(short, out, split="split")
    back = spark.read.schema("doc_id BIGINT, text STRING, split STRING").json(out)
    return wide_ints(back.select("doc_id", "split", F.length("text").alias("short_len"), digest(F.col("text")).alias("short_md5")))


FILE_QUERIES = {
    f.__name__: f
    for f in (
        files_annotations, files_verdicts, files_text_lines, files_prompt_splits, files_label_job, files_label_job_one_split, files_choice_job, files_flat_table, files_merge_job,
        files_corpus_layouts, files_extraction_job, files_span_evaluation, files_label_predictions, files_label_metrics, files_shortened,
    )
}
