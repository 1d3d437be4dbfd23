"""Queries over the given tables, one or more per operator. Each takes (spark, folder) and returns flat columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as label_fn
from ..functions import money, tokens
from ..functions.common import half_even, let, str_array
from ..functions.prompts import classification_example, relation_type, unify_prompt
from ..functions.rules import Rule, default_rules, rule_spans, stand_in_probability
from ..functions.text import WHITESPACE, clean_text, has_fullwidth_space
from ..operators import annotate, examples, label_fit, metrics, negatives, ranks, scoring, shrink, splits, validate, windows
from ..operators import merge as merging
from ..operators import spans as span_ops
from ..operators.chunk import chunk_documents, chunk_examples, chunk_summaries
from ..operators.regularize import regularize
from ..schemas import ENTITIES, PLAIN_SPANS, RELATIONS
from ..session import durable
from ..sources.readers import spread
from . import classification, extraction

Query = Callable[[SparkSession, str], DataFrame]

# Entity rules for the prose tables.
PATTERNS = {
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "phone": r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "card": r"[0-9]{16}",
    "secret": r'token = "[0-9a-f]+"',
    "email": r"[A-Za-z0-9._-]+@[A-Za-z0-9._-]+",
}
ENTITY_NAMES = list(PATTERNS)
# An address can only begin where its run of characters begins. Saying so keeps the search linear in long runs.
RULES = {name: Rule(first=r"(?<![A-Za-z0-9._-])" + p if name == "email" else p) for name, p in PATTERNS.items()}
NUMBER = r"[0-9]{3}"
NUMBER_LINE = r"[0-9]+\n"
STRATEGY_THRESHOLD = 0.5
CHUNK_LEN = 512
BUDGET = 400
LABELS = ["quality", "toxic", "en", "fr", "de", "es"]
N_DIMS = 64  # all of an embedding
SHORT_CHUNK = 24
OVERLAP_CHUNK = 96


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    # The tables with long texts, or with costly expressions per row.
    return spread(df) if name in ("documents", "orders") else df


def wide_ints(df: DataFrame) -> DataFrame:
    """All integer columns as BIGINT, so that types do not depend on the engine."""
    return df.select(*[F.col(f"`{f.name}`").cast("bigint").alias(f.name) if f.dataType.typeName() in ("integer", "short", "byte") else F.col(f"`{f.name}`") for f in df.schema])


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


@functools.cache
def _found() -> Column:
    """The spans of ``RULES`` in ``text``: one expression, whose parts are put together once."""
    return rule_spans(F.col("text"), RULES, stand_in_probability)


def with_spans(df: DataFrame, rules=None) -> DataFrame:
    return df.withColumn("spans", rule_spans(F.col("text"), rules, stand_in_probability) if rules else _found())


def show_spans(spans: Column, *fields: str) -> Column:
    """Spans as one string, so that results compare by value."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *[s[f].cast("string") for f in fields])), "|")


def digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


# --- text and spans -------------------------------------------------------------------------------


def clean(spark, folder):
    cleaned = clean_text(F.col("text"))
    return wide_ints(
        documents(spark, folder).select(
            "doc_id", digest(cleaned).alias("clean_md5"), F.length(cleaned).alias("clean_len"), has_fullwidth_space(F.col("text")).alias("fullwidth")
        )
    )


def _regularized(spark, folder):
    return regularize(with_spans(documents(spark, folder), {**RULES, "line": Rule(first=NUMBER_LINE)}))


def regularize_spans(spark, folder):
    good = validate.accepted(_regularized(spark, folder))
    return wide_ints(good.select("doc_id", F.inline("spans")).drop("probability"))


def regularize_rejects(spark, folder):
    """Of every seventh document the first span has another text than its slice."""
    docs = with_spans(documents(spark, folder), {**RULES, "line": Rule(first=NUMBER_LINE)})
    wrong = F.transform("spans", lambda x, i: x.withField("text", F.when((i == 0) & (F.col("doc_id") % 7 == 3), F.concat(x["text"], F.lit("x"))).otherwise(x["text"])))
    return validate.rejected(regularize(docs.withColumn("spans", wrong))).select("doc_id", F.col("reject_reason").alias("reason"))


def extract(spark, folder):
    return wide_ints(span_ops.span_rows(with_spans(documents(spark, folder)), ["doc_id"]))


def extract_two_stage(spark, folder):
    rules = {"address": Rule(RULES["email"].first, NUMBER, default_text="none"), "first_card": Rule(PATTERNS["card"], PATTERNS["phone"], True)}
    return wide_ints(span_ops.span_rows(documents(spark, folder).withColumn("spans", rule_spans(F.col("text"), rules)), ["doc_id"]))


def case_texts(spark, folder) -> DataFrame:
    """Short case descriptions written from the orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    age = (
        F.when(k % 4 == 0, F.concat(F.lit("原告現年"), (F.col("o_custkey") % 90).cast("string"), F.lit("歲，")))
        .when(k % 4 == 1, F.lit("原告為退休人員，"))
        .when(k % 4 == 2, F.lit("原告於民國五十年出生，"))
        .otherwise(F.concat(F.lit("原告"), c, F.lit("，")))
    )
    fault = (
        F.when(k % 3 == 0, F.concat(F.lit("被告負百分之"), (k % 100).cast("string"), F.lit("過失責任，")))
        .when(k % 3 == 1, F.lit("被告有過失，肇事逃逸，"))
        .otherwise(F.lit("雙方無爭執，"))
    )
    injury = (
        F.when(k % 5 == 0, F.concat(F.lit("受有頭部"), F.col("o_orderpriority"), F.lit("傷害，又受有腿部傷害。")))
        .when(k % 5 == 1, F.lit("受有傷。"))
        .when(k % 5 == 2, F.lit("受有輕微的傷勢。"))
        .otherwise(F.lit("。"))
    )
    return table(spark, folder, "orders").select(k.alias("order_id"), F.concat(age, fault, injury).alias("text"))


def case_rules(spark, folder):
    rules = default_rules(["age", "fault", "injury"])
    return wide_ints(span_ops.span_rows(case_texts(spark, folder).withColumn("spans", rule_spans(F.col("text"), rules)), ["order_id"]))


def _strategy(name: str) -> Query:
    def run(spark, folder):
        chosen = span_ops.select_spans(with_spans(documents(spark, folder)), name, STRATEGY_THRESHOLD)
        return wide_ints(span_ops.span_rows(chosen, ["doc_id"]))

    return run


def model_then_rules(spark, folder):
    """A model that finds only addresses of either kind; rules fill in the other entities."""
    found = documents(spark, folder).withColumn("spans", rule_spans(F.col("text"), {n: RULES[n] for n in ("ip", "email")}, stand_in_probability))
    return wide_ints(span_ops.span_rows(span_ops.rules_where_empty(found, {"ip": Rule(NUMBER), "phone": RULES["phone"]}), ["doc_id"]))


def top_span_long(spark, folder):
    long = span_ops.span_rows(with_spans(documents(spark, folder)), ["doc_id"])
    return wide_ints(span_ops.top_span(long, ["doc_id", "entity"]))


def flat_table(spark, folder):
    return wide_ints(
        span_ops.flat_entity_table(with_spans(documents(spark, folder)), ENTITY_NAMES, ["text", "start", "end", "probability"])
    )


def extract_to_table(spark, folder):
    """The flagship: scan, clean, extract, select, flatten."""
    flat = extraction.extract_to_table(documents(spark, folder), ENTITY_NAMES, RULES, clean=True, strategy="max", keys=["text", "start"])
    return wide_ints(flat)


def filled_spans(spark, folder):
    return wide_ints(span_ops.span_rows(span_ops.fill_missing(with_spans(documents(spark, folder)), ENTITY_NAMES), ["doc_id"]))


def kept_keys(spark, folder):
    nested = with_spans(documents(spark, folder)).where(F.size("spans") > 0)
    entries = F.map_entries(F.get(span_ops.as_entity_map(F.col("spans"), ["text", "start"]), F.lit(0)))
    return nested.select("doc_id", F.explode(entries).alias("kv")).select(
        "doc_id", F.col("kv.key").alias("entity"), show_spans(F.col("kv.value"), "text", "start").alias("kept")
    )


def span_rows_ge_threshold(spark, folder):
    return wide_ints(span_ops.export_rows(with_spans(documents(spark, folder)), ["doc_id"]))


def annotation_export(spark, folder):
    out = annotate.export_spans(with_spans(documents(spark, folder)), "doc_id", "reviewer@example.com")
    result = F.col("annotations")[0]["result"]
    shown = F.transform(
        result, lambda r: F.concat_ws(":", r["value"]["labels"][0], r["value"]["start"].cast("string"), r["value"]["end"].cast("string"), r["id"], r["type"])
    )
    return wide_ints(
        out.select(
            "id", digest(F.col("data.jfull_compress")).alias("text_md5"), F.col("annotations")[0]["completed_by"]["email"].alias("mail"),
            F.size(result).alias("n_results"), F.array_join(shown, "|").alias("result"),
        )
    )


# --- examples, chunks, tokens ---------------------------------------------------------------------


def _prompt_rows(spark, folder):
    return examples.prompt_examples(with_spans(documents(spark, folder)), ENTITY_NAMES)


def prompt_examples(spark, folder):
    return wide_ints(
        _prompt_rows(spark, folder).select(
            "doc_id", "prompt", F.length("content").alias("content_len"), F.size("result_list").alias("n_spans"),
            show_spans(F.col("result_list"), "start", "end", "text").alias("result"),
        )
    )


def _chunks(spark, folder, **options):
    return chunk_documents(with_spans(documents(spark, folder)), ENTITY_NAMES, options.pop("max_seq_len", CHUNK_LEN), **options)


def chunks(spark, folder):
    return wide_ints(
        validate.accepted(_chunks(spark, folder)).select(
            "doc_id", "prompt", "chunk_no", "chunk_start", F.length("content").alias("chunk_len"), digest(F.col("content")).alias("content_md5"),
            F.size("result_list").alias("n_spans"),
        )
    )


def chunk_spans(spark, folder):
    found = validate.accepted(_chunks(spark, folder)).where(F.size("result_list") > 0)
    return wide_ints(found.select("doc_id", "prompt", "chunk_no", F.inline("result_list")))


def chunk_rejects(spark, folder):
    return validate.rejected(_chunks(spark, folder, max_seq_len=SHORT_CHUNK, rejects=True)).select("doc_id", "prompt", F.col("reject_reason").alias("reason"))


def _with_overlaps(df: DataFrame) -> DataFrame:
    """Beside each span one that begins in its middle and ends three characters behind it, where the text goes on."""
    limit = F.length(F.rtrim(F.col("text"), F.lit(WHITESPACE)))
    shifted = F.transform(
        F.filter("spans", lambda s: s["end"] + 3 <= limit),
        lambda s: let(
            F.struct((s["start"] + F.floor((s["end"] - s["start"]) / 2)).cast("int").alias("a"), (s["end"] + 3).alias("b")),
            lambda x: F.struct(s["entity"].alias("entity"), s["ord"].alias("ord"), x["a"].alias("start"), x["b"].alias("end"), F.substring("text", x["a"] + 1, x["b"] - x["a"]).alias("text"), s["probability"].alias("probability")),
        ),
    )
    return df.withColumn("spans", F.concat("spans", shifted))


def chunk_overlaps(spark, folder):
    """Overlapping spans in short chunks: rows are cut where no span is, or come back whole with a reason."""
    return wide_ints(_overlap_digests(documents(spark, folder)))


def _overlap_digests(docs: DataFrame) -> DataFrame:
    """Chunks are summed up within their document; only those of documents that share an id are exchanged."""
    shown = lambda c: F.concat_ws(":", c["chunk_start"].cast("string"), F.length(c["content"]).cast("string"), show_spans(c["spans"], "start", "end", "text"))
    shared = durable(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("shared_id")))
    same = F.col("doc_id").eqNullSafe(F.col("shared_id"))

    def summed(part: DataFrame) -> DataFrame:
        return chunk_summaries(_with_overlaps(with_spans(part)), ENTITY_NAMES, shown, OVERLAP_CHUNK).withColumnRenamed(validate.REASON, "reason")

    alone = summed(docs.join(shared, same, "left_anti"))
    together = summed(docs.join(shared, same, "left_semi")).groupBy("doc_id", "prompt", "reason").agg(
        F.sum("n_chunks").alias("n_chunks"), F.sum("n_spans").alias("n_spans"), F.array_sort(F.flatten(F.collect_list("pieces"))).alias("pieces")
    )
    pieces = F.array_join(F.transform("pieces", lambda p: p["shown"]), "|")
    return alone.unionByName(together).select("doc_id", "prompt", "reason", "n_chunks", "n_spans", digest(pieces).alias("pieces_md5"))


def chunk_by_prompt(spark, folder):
    """Chunks of rows that were expanded by prompt before: the same as those of whole documents."""
    rows = chunk_examples(_prompt_rows(spark, folder), CHUNK_LEN)
    return wide_ints(validate.accepted(rows).groupBy("doc_id", "prompt").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("content")).alias("chars"), F.sum(F.size("result_list")).alias("n_spans")))


def chunk_lenient(spark, folder):
    found = _chunks(spark, folder, strict=False, max_seq_len=64)
    return wide_ints(
        validate.accepted(found).select(
            "doc_id", "prompt", "chunk_no", "chunk_start", digest(F.col("content")).alias("content_md5"),
            show_spans(F.col("result_list"), "start", "end", "text").alias("result"), F.size("dropped_spans").alias("n_dropped"),
        )
    )


def _offsets(length: int = CHUNK_LEN) -> Column:
    return tokens.char_offsets(F.col("prompt"), F.col("content"), length)


def token_align(spark, folder):
    found = validate.accepted(_chunks(spark, folder)).where(F.size("result_list") > 0)
    placed = found.withColumn("__o", _offsets()).withColumns({"__shifted": tokens.drift_offsets(F.col("__o")), "drift": tokens.offset_drift(F.col("__o"))})
    rows = placed.select("doc_id", "prompt", "chunk_no", "drift", "__shifted", F.inline("result_list"))
    return wide_ints(
        rows.select(
            "doc_id", "prompt", "chunk_no", "drift", "start", "end",
            tokens.align_offset(F.col("start") + F.col("drift"), F.col("__shifted")).alias("first_token"),
            tokens.map_offset(F.col("end") - 1 + F.col("drift"), F.col("__shifted")).alias("last_token"),
        )
    )


def position_vectors(spark, folder):
    vectors = validate.accepted(_chunks(spark, folder)).select(
        "doc_id", "prompt", "chunk_no", tokens.position_vectors(F.col("result_list"), _offsets(), CHUNK_LEN).alias("v")
    )

    def ones(field: str) -> Column:
        v = F.col("v")[field]
        places = F.array_join(F.filter(F.transform(v, lambda x, i: F.when(x == 1.0, i)), lambda i: i.isNotNull()).cast("array<string>"), ",")
        return F.when(F.array_contains(v, F.lit(1.0).cast("float")), places).otherwise(F.lit(""))

    return wide_ints(
        vectors.select(
            "doc_id", "prompt", "chunk_no", F.size("v.start_positions").alias("length"), ones("start_positions").alias("starts"), ones("end_positions").alias("ends")
        )
    )


def character_model():
    """A model without weights: runs of digits, or of capitals, are sure; a run's first and last characters start and end it."""
    import numpy as np

    bounds = {"digits": (48, 57), "capitals": (65, 90)}

    def score(prompts, contents):
        for prompt, content in zip(prompts, contents, strict=True):
            codes = np.frombuffer(content.encode("utf-32-le"), "<u4")
            inside = np.concatenate([[False], (codes >= bounds[prompt][0]) & (codes <= bounds[prompt][1]), [False]])
            yield (inside[1:-1] & ~inside[:-2]).astype(float), (inside[1:-1] & ~inside[2:]).astype(float)

    return score


def model_window_spans(spark, folder):
    """Spans of a batch model over windows, as of whole documents."""
    found = windows.model_spans(documents(spark, folder), character_model, ["digits", "capitals"], window=256, overlap=40)
    return wide_ints(found.select("doc_id", F.inline("spans")))


def pad_bucket(spark, folder):
    n = F.length("text") + 3
    return wide_ints(documents(spark, folder).select("doc_id", tokens.padding_bucket(n, [1024, 128, 512, 256], CHUNK_LEN).alias("bucket")))


# --- shrinking ------------------------------------------------------------------------------------


def _overlapping(spark, folder):
    return with_spans(documents(spark, folder), {**RULES, "number": Rule(first=NUMBER)})


def greedy_dedup(spark, folder):
    kept = shrink.greedy_distinct(F.col("spans"), 0.4)
    return wide_ints(_overlapping(spark, folder).select("doc_id", F.inline(kept)))


def span_windows(spark, folder):
    kept = shrink.greedy_distinct(F.col("spans"), 0.4)
    windows = let(kept, lambda k: shrink.span_windows(k, half_even(F.lit(BUDGET) / F.size(k)), F.length("text")))
    return wide_ints(_overlapping(spark, folder).select("doc_id", F.posexplode(windows).alias("n", "w")).select("doc_id", "n", "w.start", "w.end"))


def _shrunk(**options) -> Query:
    def run(spark, folder):
        out = shrink.shrink_documents(_overlapping(spark, folder), BUDGET, **options)
        return wide_ints(out.select("doc_id", F.length("text").alias("short_len"), digest(F.col("text")).alias("short_md5")))

    return run


def row_counts(spark, folder):
    """Rows and characters before and after shrinking, in one pass."""
    out = _overlapping(spark, folder).withColumn("full", F.length("text"))
    out = shrink.shrink_documents(out, BUDGET)
    return out.agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("full").alias("chars_before"), F.sum(F.length("text")).alias("chars_after"), F.max("full").cast("bigint").alias("longest")
    )


def template_budget(spark, folder):
    """Budget left by a label template whose labels are the event types."""
    kinds = table(spark, folder, "events").select("event_type").distinct()
    places = 1 + F.length(F.regexp_replace("event_type", r"(?U)^\s+|\s+$", ""))
    n, length = kinds.agg(F.count(F.lit(1)), F.coalesce(F.sum(places), F.lit(0)) + label_fn.template_length([])).first()
    return spark.createDataFrame([(n, length, label_fn.budget_left(length, 768))], "n_labels bigint, template_len bigint, budget bigint")


# --- negatives and relations ----------------------------------------------------------------------


def _label_facts(spark, folder):
    docs = with_spans(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    found = F.array_distinct(F.concat(F.array("lang", "source"), F.transform("spans", lambda s: s["entity"])))
    return docs.select("doc_id", found.alias("labels"))


def entity_negatives(spark, folder):
    facts = durable(_label_facts(spark, folder))
    index = negatives.corpus_indexes(facts, {"labels": F.col("labels")}, 7)["labels"]
    return negatives.entity_negatives(facts, index, "doc_id", 2, 7)


def corpus_label_sets(spark, folder):
    return examples.corpus_values(_label_facts(spark, folder), F.col("labels")).withColumn("n_chars", F.length("value").cast("bigint"))


def label_difference(spark, folder):
    """Symmetric difference of a document's labels and a fixed set."""
    base = str_array(ENTITY_NAMES)
    own = F.col("labels")
    diff = F.array_sort(F.array_union(F.array_except(own, base), F.array_except(base, own)))
    return _label_facts(spark, folder).select("doc_id", F.array_join(diff, ",").alias("difference"))


def customer_corpus(spark, folder) -> DataFrame:
    """One document per customer with entities and relations, in the normalised corpus layout."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    df = table(spark, folder, "customer").join(nation, "c_nationkey")
    n, a, s = F.col("c_name"), F.col("n_name"), F.col("c_mktsegment")
    at_nation = F.length(n) + 1
    at_segment = at_nation + F.length(a) + 1

    def entity(i: int, label: Column, start: Column, end: Column) -> Column:
        return F.struct(F.lit(i).cast("bigint").alias("id"), label.alias("label"), start.cast("int").alias("start_offset"), end.cast("int").alias("end_offset"))

    def relation(i: int, a: int, b: int, kind: str) -> Column:
        return F.struct(F.lit(i).cast("bigint").alias("id"), F.lit(a).cast("bigint").alias("from_id"), F.lit(b).cast("bigint").alias("to_id"), F.lit(kind).alias("type"))

    rich = F.when(F.col("c_acctbal") > 5000, F.lit("customer##rich")).when(F.col("c_acctbal") < 0, F.lit("customer##poor##late")).otherwise(F.lit("customer"))
    entities = [
        entity(1, rich, F.lit(0), F.length(n)),
        entity(2, F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")), at_nation, at_nation + F.length(a)),
    ]
    third = entity(3, F.lit("segment"), at_segment, at_segment + F.length(s))
    has_segment = F.col("c_custkey") % 3 == 0
    relations = F.when(has_segment, F.array(relation(1, 1, 2, "home"), relation(2, 1, 3, "market"), relation(3, 2, 3, "trade"))).when(
        F.col("c_custkey") % 3 == 1, F.array(relation(1, 1, 2, "home"))
    )
    return df.select(
        F.col("c_custkey").alias("doc_id"),
        F.concat_ws(" ", n, a, s).alias("text"),
        F.when(has_segment, F.array(*entities, third)).otherwise(F.array(*entities)).cast(ENTITIES).alias("entities"),
        F.coalesce(relations, F.array()).cast(RELATIONS).alias("relations"),
    )


def _relation_facts(spark, folder):
    docs = examples.resolved_relations(examples.named_entities(customer_corpus(spark, folder)))
    return docs, examples.corpus_facts(docs, "doc_id")


def relation_full_negatives(spark, folder):
    facts = durable(_relation_facts(spark, folder)[1])
    predicates = negatives.corpus_indexes(facts, {"predicates": F.col("predicates")}, 7)["predicates"]
    return negatives.full_relation_negatives(facts, predicates, "doc_id")


def relation_train_negatives(spark, folder):
    facts = durable(_relation_facts(spark, folder)[1])
    sets = negatives.corpus_indexes(facts, {"names": F.col("entity_names"), "labels": F.col("labels")}, 7)
    out = negatives.train_relation_negatives(facts, sets["names"], sets["labels"], "doc_id", 5, "ch", 7)
    return out.withColumn("pool", F.col("pool").cast("bigint"))


def relation_positives(spark, folder):
    docs, _ = _relation_facts(spark, folder)
    return examples.relation_examples(docs, "doc_id").select("doc_id", "prompt", show_spans(F.col("result_list"), "start", "end", "text").alias("result"))


def entity_positives(spark, folder):
    docs, _ = _relation_facts(spark, folder)
    return examples.entity_examples(docs, "doc_id").select("doc_id", "prompt", show_spans(F.col("result_list"), "start", "end", "text").alias("result"))


def aspect_prompts(spark, folder):
    docs, _ = _relation_facts(spark, folder)
    out = examples.aspect_examples(docs, "doc_id", prefix="mood", options=["rich", "poor", "late"], lang="en", seed=7)
    return out.select("doc_id", "prompt", show_spans(F.col("result_list"), "text", "start", "end").alias("result"))


def _example_rows(out: DataFrame) -> DataFrame:
    shown = out.select("doc_id", "kind", digest(F.col("content")).alias("content_md5"), "prompt", show_spans(F.col("result_list"), "text", "start", "end").alias("result"))
    return wide_ints(shown)


def extraction_examples(spark, folder):
    """The whole conversion for training."""
    out = examples.build_extraction_examples(customer_corpus(spark, folder), "doc_id", 5, options=["rich", "poor", "late"], seed=7)
    return _example_rows(out)


def dev_examples(spark, folder):
    """The whole conversion for evaluation: all negatives."""
    out = examples.build_extraction_examples(customer_corpus(spark, folder), "doc_id", -1, options=["rich", "poor", "late"], seed=7, is_train=False)
    return _example_rows(out)


def relation_resolve(spark, folder):
    """Each turn answers the turn before it: relation ends are looked up by (conversation, turn).

    Planted: a second entity for every third turn's id, listed first or last; relations to no entity; relations without a label.
    """
    turns = table(spark, folder, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "role", "text")
    own = turns.select("doc_id", F.col("turn").alias("id"), F.lit(1).alias("ord"), F.col("role").alias("name"), F.lit(0).alias("start"), F.length("text").alias("end"))
    doubled = turns.where("turn % 3 = 1").select(
        "doc_id", F.col("turn").alias("id"), F.when(F.col("doc_id") % 2 == 0, 0).otherwise(2).alias("ord"), F.lit("other").alias("name"), F.lit(7).alias("start"), F.lit(9).alias("end")
    )
    kind = F.when(F.col("doc_id") % 11 != 0, F.lit("answers"))
    to = F.when(F.col("doc_id") % 13 == 5, F.col("turn") + 1000).otherwise(F.col("turn") - 1)
    relations = turns.where("turn > 0").select("doc_id", F.col("turn").alias("from_id"), to.alias("to_id"), kind.alias("type"))
    found = examples.resolve_relations(relations, own.unionByName(doubled))
    return wide_ints(found.select("doc_id", "from_id", "to_id", "type", "subject", "object", "start", "end", F.col("reject_reason").alias("reason")))


def relation_types(spark, folder):
    docs, _ = _relation_facts(spark, folder)
    prompts = examples.relation_examples(docs, "doc_id").select(relation_type(F.col("prompt")).alias("relation"))
    return prompts.groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


# --- prompts, splits ------------------------------------------------------------------------------


def _class_prompts(spark, folder):
    docs = table(spark, folder, "documents")
    example = classification_example(F.col("text"), F.array("lang"), "language", ["en", "fr", "de", "es"], 7, [F.col("doc_id")])
    return docs.select("doc_id", example.alias("x"))


def cls_prompts(spark, folder):
    return _class_prompts(spark, folder).select("doc_id", "x.prompt", show_spans(F.col("x.result_list"), "text", "start", "end").alias("result"))


def unify_prompts(spark, folder):
    """Options in any order and doubled; every third prompt has none."""
    c = F.col
    options = F.when(c("doc_id") % 3 != 0, F.concat(F.lit("["), F.concat_ws(",", c("source"), F.lit("en"), c("lang"), c("source")), F.lit("]"))).otherwise(F.lit(""))
    docs = table(spark, folder, "documents").select("doc_id", F.concat(F.lit("kind of "), c("lang"), options).alias("prompt"))
    return docs.select("doc_id", unify_prompt(F.col("prompt")).alias("prompt"))


def split_ie(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("n_chars"))
    return splits.split_extraction(docs, "doc_id", [0.8, 0.1, 0.1], 1000).select("doc_id", "split")


def split_tc(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return splits.split_classification(docs, "doc_id", [0.75, 0.2, 0.05], 1000)


def split_in_order(spark, folder):
    docs = table(spark, folder, "orders").select("o_orderkey")
    return splits.split_classification(docs, "o_orderkey", [0.7, 0.2, 0.1], shuffle=False)


def split_signed(spark, folder):
    """Keys below and above zero, in their order."""
    docs = table(spark, folder, "orders").select((F.lit(20_000) - F.col("o_orderkey")).cast("bigint").alias("key"))
    return splits.split_classification(docs, "key", [0.7, 0.2, 0.1], shuffle=False)


def split_by_name(spark, folder):
    """String keys with a long common beginning, in the order of their bytes."""
    docs = table(spark, folder, "customer").select(F.concat(F.lit("Kunde/Käufer/"), F.col("c_name"), F.lit("/"), F.col("c_mktsegment")).alias("key"))
    return splits.split_extraction(docs, "key", [0.6, 0.3, 0.1], shuffle=False)


def shuffle_rank(spark, folder):
    return ranks.seeded_rank(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 1000)


def running_ids(spark, folder):
    """Running ids over the corpus: documents from 1, entities continue over documents."""
    rows = table(spark, folder, "documents").select(
        F.col("doc_id"), F.col("text").alias("body")
    )
    rows = rows.withColumn("spans", rule_spans(F.col("body"), RULES))
    spans = F.col("spans")
    result = F.transform(
        spans,
        lambda s, i: F.struct(
            i.cast("string").alias("id"), F.lit("labels").alias("type"),
            F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), F.array(s["entity"]).alias("labels")).alias("value"),
            F.lit(None).cast("string").alias("from_id"), F.lit(None).cast("string").alias("to_id"), F.lit(None).cast("array<string>").alias("labels"),
        ),
    )
    # Every entity but the first is tied to the one before it.
    links = F.transform(
        F.slice(spans, 2, F.greatest(F.size(spans), F.lit(1))),
        lambda s, i: F.struct(
            F.concat(F.lit("r"), i.cast("string")).alias("id"), F.lit("relation").alias("type"),
            F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("array<string>").alias("labels")).alias("value"),
            (i + 1).cast("string").alias("from_id"), i.cast("string").alias("to_id"), F.array(F.lit("next")).alias("labels"),
        ),
    )
    annotated = rows.select("doc_id", "body", F.array(F.struct(F.concat(result, links).alias("result"))).alias("annotations"))
    corpus = examples.annotations_to_corpus(annotated, "doc_id", "body")
    return corpus.select(
        "doc_id", "id", show_spans(F.col("entities"), "id", "label", "start_offset").alias("entities"), show_spans(F.col("relations"), "id", "from_id", "to_id").alias("relations")
    )


# --- labels ---------------------------------------------------------------------------------------


def _labelled(spark, folder):
    names = F.filter(
        F.array(F.when(F.col("quality") == 1, F.lit("quality")), F.when(F.col("toxic") == 1, F.lit("toxic")), F.col("lang")), lambda x: x.isNotNull()
    )
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return table(spark, folder, "labels").join(docs, "doc_id").select("doc_id", "text", names.alias("choices"))


def label_examples(spark, folder):
    out = validate.accepted(examples.label_examples(_labelled(spark, folder), LABELS, separator="\n"))
    return wide_ints(
        out.select(
            "doc_id", digest(F.col("text_a")).alias("a_md5"), F.length("text_b").alias("b_len"), F.size("choices").alias("n_choices"),
            F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"),
        )
    )


def label_rejects(spark, folder):
    out = validate.rejected(examples.label_examples(_labelled(spark, folder), LABELS[:4], separator="\n"))
    return out.select("doc_id", F.col("reject_reason").alias("reason"))


def _raw_label_rows(spark, folder):
    """Every document, and for every fifth a row of its own that is too short."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = docs.unionByName(docs.where("doc_id % 5 = 0").withColumn("text", F.lit("no")))
    return rows.select(
        F.col("text").alias("text_a"),
        F.lit("").alias("question"),
        F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("one"))).otherwise(str_array(LABELS)).alias("choices"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("["), (F.col("doc_id") % 3).cast("string"), F.lit(", 5]"))).otherwise(F.lit("1")).alias("labels"),
    )


def label_filter_stats(spark, folder):
    return examples.skipped_examples(_raw_label_rows(spark, folder))


def multi_hot(spark, folder):
    out = examples.standard_label_examples(_raw_label_rows(spark, folder))
    shown = F.array_join(F.transform("labels", lambda x: x.cast("int").cast("string")), "")
    return out.groupBy(shown.alias("vector"), "text_b").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text_a")).alias("chars"))


def inference_rows(spark, folder):
    rows = examples.inference_rows(documents(spark, folder), LABELS)
    return wide_ints(rows.select("doc_id", digest(F.col("text_a")).alias("a_md5"), "text_b", F.array_join("choices", ",").alias("choices")))


def _logits(spark, folder):
    df = table(spark, folder, "embeddings")
    logits = F.transform("embedding", lambda x: x.cast("double") * 8)
    truth = F.transform(F.sequence(F.lit(0), F.lit(N_DIMS - 1)), lambda i: F.when((F.col("vec_id") + i * F.col("label")) % 3 == 0, F.lit(1)).otherwise(F.lit(0)))
    return df.select("vec_id", logits.alias("logits"), truth.alias("labels"))


def label_decode(spark, folder):
    hits = label_fn.decode_logits(F.col("logits"))
    return _logits(spark, folder).select(
        "vec_id",
        F.array_join(F.transform(hits, lambda h: h["label"].cast("string")), ",").alias("hits"),
        F.round(F.aggregate(hits, F.lit(0.0), lambda a, h: a + h["prob"]), 6).alias("prob_sum"),
    )


def label_map(spark, folder):
    names = [f"d{i}" for i in range(N_DIMS)]
    decoded = scoring.decode_labels(_logits(spark, folder).drop("labels"), names)
    return wide_ints(merging.expand_labels(decoded, names))


def label_annotation_export(spark, folder):
    flags = F.create_map(F.lit("quality"), F.col("quality"), F.lit("toxic"), F.col("toxic"))
    results = table(spark, folder, "labels").select(F.col("doc_id").alias("jid"), (F.col("doc_id") * 10).alias("id"), flags.alias("pred_labels"))
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("jid"), F.lit(1).alias("version"), "text")
    older = docs.select("jid", F.lit(0).alias("version"), F.lit("old").alias("text"))
    out = annotate.export_labels(annotate.attach_text(results, docs.unionByName(older), order="version"))
    r = F.col("annotations")[0]["result"][0]
    return out.select(
        "id", F.col("data.jid").alias("jid"), digest(F.col("data.jfull_compress")).alias("text_md5"),
        F.array_join(r["value"]["choices"], ",").alias("choices"), r["type"].alias("type"),
    )


# --- merge, money ---------------------------------------------------------------------------------


def _merge_sides(spark, folder):
    c = table(spark, folder, "customer")
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    left = c.select(F.col("c_custkey").cast("string").alias("jid"), segment.alias("kind"), F.concat(F.col("c_name"), F.lit("!")).alias("entity"))
    flags = F.create_map(F.lit("good"), (F.col("c_acctbal") > 0).cast("int"), F.lit("big"), (F.col("c_acctbal") > 5000).cast("int"))
    right = c.select(F.col("c_custkey").alias("jid"), segment.alias("kind"), F.col("c_nationkey").alias("nation"), flags.alias("pred_labels"))
    return left, right


def merge_results(spark, folder):
    left, right = _merge_sides(spark, folder)
    return wide_ints(merging.merge_results(left, merging.expand_labels(right, ["good", "big"])))


def merge_guard(spark, folder):
    """Counts of a merge on the segment alone: hot keys, many to many, computed without joining."""
    left, right = _merge_sides(spark, folder)
    return merging.merge_guard(left, right.where("jid % 4 <> 1"), ["kind"])


def _amounts(spark, folder):
    k = F.col("o_orderkey")
    n = F.floor("o_totalprice").cast("bigint")
    high, low = F.floor(n / 10000).cast("bigint"), n % 10000
    digit = [F.floor(low / w).cast("bigint") % 10 for w in (1000, 100, 10, 1)]
    spelled = F.concat(*[F.concat(F.translate(d.cast("string"), "0123456789", "零壹貳參肆伍陸柒捌玖"), F.lit(u)) for d, u in zip(digit, ("仟", "佰", "拾", ""))])
    raw = (
        F.when(k % 13 == 0, F.lit("不詳"))
        .when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 0, F.concat(F.when(high > 0, F.concat(high.cast("string"), F.lit("萬"))).otherwise(F.lit("")), low.cast("string"), F.lit("元")))
        .when(k % 4 == 1, F.concat(
            F.when(high > 0, F.concat(F.translate(high.cast("string"), "0123456789", "０１２３４５６７８９"), F.lit("万"))).otherwise(F.lit("")), spelled, F.lit("餘元")
        ))
        .when(k % 4 == 2, F.concat(F.lit(" "), F.regexp_replace(n.cast("string"), r"(\d)(?=(?:\d{3})+$)", "$1,"), F.lit("元")))
        .otherwise(F.concat(F.lit("新"), n.cast("string")))
    )
    return table(spark, folder, "orders").select(k.alias("order_id"), F.col("o_custkey").alias("cust_id"), raw.alias("amount"))


def money_normalize(spark, folder):
    return _amounts(spark, folder).select("order_id", money.money_to_number(F.col("amount")).alias("amount"))


def money_columns(spark, folder):
    out = money.convert_money_columns(_amounts(spark, folder).withColumn("copy", F.col("amount")), ["amount", "absent"])
    return out.select("order_id", "amount")


def money_error_rate(spark, folder):
    return money.conversion_error_rate(_amounts(spark, folder).withColumn("age", (F.col("cust_id") % 90).cast("string")), ["amount", "age"])


def money_failures(spark, folder):
    return money.failed_amounts(_amounts(spark, folder), "amount")


def zero_fill(spark, folder):
    k = F.col("o_orderkey")

    def spell(x):
        return F.translate((x % 9 + 1).cast("string"), "123456789", "一二三四五六七八九")

    raw = (
        F.when(k % 3 == 0, F.concat(spell(k), F.lit("萬"), spell(F.col("o_custkey")), F.lit("百元")))
        .when(k % 3 == 1, F.concat(spell(k), F.lit("千"), spell(F.col("o_custkey")), F.lit("元")))
        .otherwise(F.concat(spell(k), F.lit("亿"), spell(F.col("o_custkey")), F.lit("千元")))
    )
    return table(spark, folder, "orders").select(k.alias("order_id"), money.fill_zeros(raw).alias("filled"))


# --- metrics --------------------------------------------------------------------------------------


def _gold_and_predicted(spark, folder):
    """Gold: the rules. Predicted: the same with a looser card rule and without some addresses."""
    looser = {**RULES, "card": Rule(r"[0-9]{12,16}"), "email": Rule(r"(?<![A-Za-z0-9.])[A-Za-z0-9.]+@[A-Za-z0-9.]+")}
    df = documents(spark, folder).select(
        "doc_id", rule_spans(F.col("text"), RULES).alias("g"), rule_spans(F.col("text"), looser, stand_in_probability).alias("p")
    )
    rows = df.select("doc_id", "g", "p", F.explode(str_array(ENTITY_NAMES)).alias("entity"))
    return rows.select(
        "doc_id", "entity",
        F.filter("g", lambda s: s["entity"] == F.col("entity")).alias("gold"),
        F.filter("p", lambda s: (s["entity"] == F.col("entity")) & (s["probability"] > 0.1)).alias("predicted"),
    )


def span_prf_total(spark, folder):
    return metrics.span_metrics(_gold_and_predicted(spark, folder))


def span_prf_by_class(spark, folder):
    return metrics.span_metrics(_gold_and_predicted(spark, folder), by="entity")


def span_prf_long(spark, folder):
    pairs = _gold_and_predicted(spark, folder)
    gold, predicted = (pairs.select("doc_id", F.inline(F.transform(c, lambda s: F.struct(s["entity"].alias("entity"), s["start"].alias("start"), s["end"].alias("end"))))) for c in ("gold", "predicted"))
    return metrics.span_metrics_long(gold, predicted, ["doc_id", "entity", "start", "end"], "entity")


def entity_prefix_check(spark, folder):
    names = table(spark, folder, "part").select(F.col("p_type").alias("name")).union(table(spark, folder, "nation").select("n_name"))
    return wide_ints(metrics.prefix_check(names, "name"))


def _predicted_labels(spark, folder):
    return _logits(spark, folder).withColumn("predicted", metrics.predictions(F.col("logits")))


def multilabel_metrics(spark, folder):
    return metrics.multilabel_metrics(_predicted_labels(spark, folder), N_DIMS)


def label_report(spark, folder):
    return metrics.label_report(_predicted_labels(spark, folder), [f"d{i}" for i in range(N_DIMS)])


def ranking_loss(spark, folder):
    masked = F.transform("labels", lambda y, i: F.when((F.col("vec_id") + i) % 11 == 0, F.lit(-100)).otherwise(y))
    return metrics.ranking_loss(_logits(spark, folder).withColumn("labels", masked))


def span_bce(spark, folder):
    probs = F.transform("logits", lambda x: label_fn.sigmoid(x))
    df = _logits(spark, folder).select(
        probs.alias("start_prob"), F.reverse(probs).alias("end_prob"), F.col("labels").alias("start_positions"), F.col("labels").alias("end_positions")
    )
    return metrics.span_loss(df)


def validate_examples(spark, folder):
    """Prompt examples with planted faults, by reason."""
    rows = _prompt_rows(spark, folder)
    broken = F.when(F.col("doc_id") % 4 == 1, F.transform("result_list", lambda s: s.withField("start", s["start"] + 1))).otherwise(F.col("result_list"))
    prompt = F.when(F.col("doc_id") % 9 == 0, F.lit("other")).otherwise(F.col("prompt"))
    content = F.when(F.col("doc_id") % 10 == 3, F.lit(None).cast("string")).otherwise(F.col("content"))
    rows = rows.select("doc_id", content.alias("content"), broken.cast(PLAIN_SPANS).alias("result_list"), prompt.alias("prompt"))
    out = validate.rejected(validate.validate_prompt_examples(rows, ENTITY_NAMES))
    return out.groupBy(F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# --- models ---------------------------------------------------------------------------------------


def keyword_scorer():
    """A label scorer for the two-stage query: one logit per label from simple text features."""

    def score(texts: list[str]) -> list[list[float]]:
        return [[0.01 * len(t) - 1.0, 1.0 if "@" in t else -1.0, 1.0 if any(c.isdigit() for c in t) else -1.0] for t in texts]

    return score


def two_stage_classify(spark, folder):
    out = classification.classify_documents(
        documents(spark, folder), ["long", "address", "digits"], {**RULES, "number": Rule(first=NUMBER)}, max_seq_len=BUDGET + 24, make_label_scorer=keyword_scorer
    )
    return wide_ints(merging.expand_labels(out.select("doc_id", F.length("text").alias("short_len"), "pred_labels"), ["long", "address", "digits"]))


def fit_labels(spark, folder):
    """Fit quality and language on one split: rows of both, the vocabulary, and whether the fit beats the majority of each label on the other split."""
    names = ["quality", "en", "fr"]
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").join(table(spark, folder, "labels"), "doc_id")
    truth = F.array(F.col("quality"), (F.col("lang") == "en").cast("int"), (F.col("lang") == "fr").cast("int"))
    parts = durable(splits.split_classification(docs.select("doc_id", "text", truth.alias("labels")), "doc_id", [0.7, 0.3, 0.0], 7))
    train, dev = parts.where("split = 'train'"), parts.where("split = 'dev'")
    model, report = label_fit.fit_labels(train, names, dev=dev, n_features=1 << 14, strengths=(1e-4, 1e-2), max_iter=15)
    # The answer that most training rows have, for every row.
    most = train.agg(*[(F.avg(F.get("labels", F.lit(i))) >= 0.5).cast("int").alias(f"m{i}") for i in range(len(names))]).first()
    blind = metrics.multilabel_metrics(dev.select("labels", F.array(*[F.lit(m) for m in most]).alias("predicted")), len(names))
    rows = parts.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "dev").alias("n_dev"))
    reached, floor = report.first()["macro_f1"], blind.first()["macro_f1"]
    return rows.withColumns({"vocabulary": F.lit(",".join(model.labels)), "beats_majority": F.lit(reached > floor)})


QUERIES: dict[str, Query] = {
    "clean_text": clean,
    "regularize_spans": regularize_spans,
    "regularize_rejects": regularize_rejects,
    "extract_spans": extract,
    "extract_two_stage": extract_two_stage,
    "case_rules": case_rules,
    "model_then_rules": model_then_rules,
    "strategy_all": _strategy("all"),
    "strategy_threshold": _strategy("threshold"),
    "strategy_max": _strategy("max"),
    "top_span_long": top_span_long,
    "filled_spans": filled_spans,
    "kept_keys": kept_keys,
    "flat_entity_table": flat_table,
    "extract_to_table": extract_to_table,
    "span_rows_ge_threshold": span_rows_ge_threshold,
    "annotation_export": annotation_export,
    "prompt_examples": prompt_examples,
    "chunk_examples": chunks,
    "chunk_spans": chunk_spans,
    "chunk_rejects": chunk_rejects,
    "chunk_overlaps": chunk_overlaps,
    "chunk_by_prompt": chunk_by_prompt,
    "chunk_lenient": chunk_lenient,
    "token_align": token_align,
    "position_vectors": position_vectors,
    "model_window_spans": model_window_spans,
    "pad_bucket": pad_bucket,
    "greedy_dedup": greedy_dedup,
    "span_windows": span_windows,
    "shrink_documents": _shrunk(),
    "shrink_documents_compat": _shrunk(compat=True),
    "shrink_documents_static": _shrunk(dynamic=False),
    "row_counts": row_counts,
    "template_budget": template_budget,
    "entity_negatives": entity_negatives,
    "corpus_label_sets": corpus_label_sets,
    "label_difference": label_difference,
    "relation_full_negatives": relation_full_negatives,
    "relation_train_negatives": relation_train_negatives,
    "relation_positives": relation_positives,
    "entity_positives": entity_positives,
    "aspect_prompts": aspect_prompts,
    "extraction_examples": extraction_examples,
    "dev_examples": dev_examples,
    "relation_resolve": relation_resolve,
    "relation_types": relation_types,
    "cls_prompts": cls_prompts,
    "unify_prompts": unify_prompts,
    "split_ie": split_ie,
    "split_tc": split_tc,
    "split_in_order": split_in_order,
    "split_signed": split_signed,
    "split_by_name": split_by_name,
    "shuffle_rank": shuffle_rank,
    "running_ids": running_ids,
    "label_examples": label_examples,
    "label_rejects": label_rejects,
    "label_filter_stats": label_filter_stats,
    "multi_hot": multi_hot,
    "inference_rows": inference_rows,
    "label_decode": label_decode,
    "label_map": label_map,
    "label_annotation_export": label_annotation_export,
    "merge_results": merge_results,
    "merge_guard": merge_guard,
    "money_normalize": money_normalize,
    "money_columns": money_columns,
    "money_error_rate": money_error_rate,
    "money_failures": money_failures,
    "zero_fill": zero_fill,
    "span_prf_total": span_prf_total,
    "span_prf_by_class": span_prf_by_class,
    "span_prf_long": span_prf_long,
    "entity_prefix_check": entity_prefix_check,
    "multilabel_metrics": multilabel_metrics,
    "label_report": label_report,
    "ranking_loss": ranking_loss,
    "span_bce": span_bce,
    "validate_examples": validate_examples,
    "two_stage_classify": two_stage_classify,
    "fit_labels": fit_labels,
}
