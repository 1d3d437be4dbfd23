"""Building model examples from annotated documents: prompts, relations, classes and label vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LABEL_SEPARATOR, NEGATIVE_RATIO, PAIR_SEPARATOR, PROMPT_OPTIONS, PROMPT_PREFIX, SEED, SUBJECT_LINK
from ..functions.common import let, slice_of, stable_sort_by, str_array
from ..functions.labels import label_indexes, multi_hot
from ..functions.prompts import classification_example, relation_prompt, split_class_labels
from ..functions.text import split_pair
from ..schemas import ENTITIES, PLAIN_SPANS, RELATIONS
from ..session import durable
from .negatives import corpus_indexes, entity_negatives, full_relation_negatives, train_relation_negatives
from .ranks import running_totals
from .validate import REASON, known_labels, only_span_annotations, stop_on


def annotation_spans(df: DataFrame, index: int = 0, out: str = "spans") -> DataFrame:
    """Span labels of one annotation of each document, sorted by start, as ``ARRAY<STRUCT<entity, start, end, text>>``."""
    result = F.coalesce(F.get(F.col("annotations"), F.lit(index))["result"], F.array())
    spans = F.transform(
        F.filter(result, lambda r: r["type"] == "labels"),
        lambda r: F.struct(
            F.get(r["value"]["labels"], F.lit(0)).alias("entity"), r["value"]["start"].alias("start"),
            r["value"]["end"].alias("end"), r["value"]["text"].alias("text"),
        ),
    )
    reason = only_span_annotations(F.transform(result, lambda r: r["type"]))
    return df.withColumn(out, stable_sort_by(spans, "start")).withColumn(REASON, reason)


def prompt_examples(df: DataFrame, entities: Sequence[str], text: str = "text", spans: str = "spans", strict: bool = False) -> DataFrame:
    """One row per document and entity with that entity's spans, or none.

    The entity list is a literal, so each document is expanded in place: no join, no shuffle.
    """
    if strict and REASON in df.columns:
        df = stop_on(df, True)
    keep = [c for c in df.columns if c not in {text, spans, REASON}]
    wanted = F.explode(str_array(entities)).alias("prompt")
    ordered = stable_sort_by(F.col(spans), "start")
    rows = df.withColumn(spans, ordered).select(*keep, text, spans, wanted)
    mine = F.transform(
        F.filter(F.col(spans), lambda s: s["entity"] == F.col("prompt")),
        lambda s: F.struct(s["text"].alias("text"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return rows.select(*keep, F.col(text).alias("content"), mine.cast(PLAIN_SPANS).alias("result_list"), "prompt")


# --- documents with entities and relations -------------------------------------------------------


def annotations_to_corpus(df: DataFrame, key: str, text: str = "data.jfull_compress", index: int = 0) -> DataFrame:
    """Flatten annotations to ``key, id, text, entities, relations`` with running ids over the corpus.

    Spans are numbered in order of their start; relation ends are looked up within the document.
    """
    result = F.coalesce(F.get(F.col("annotations"), F.lit(index))["result"], F.array())
    labels = stable_sort_by(
        F.transform(
            F.filter(result, lambda r: r["type"] == "labels"),
            lambda r: F.struct(
                r["value"]["start"].alias("start"), r["value"]["end"].alias("end"), r["id"].alias("rid"),
                F.get(r["value"]["labels"], F.lit(0)).alias("label"),
            ),
        ),
        "start",
    )
    relations = F.filter(result, lambda r: r["type"] == "relation")
    base = df.select(
        F.col(key), F.col(text).alias("text"), labels.alias("__labels"),
        F.transform(
            relations,
            lambda r: F.struct(r["from_id"].alias("f"), r["to_id"].alias("t"), F.get(r["labels"], F.lit(0)).alias("type")),
        ).alias("__relations"),
    )
    # Written out first: the range partitioning below reads its input twice.
    sizes = durable(base.select(key, F.size("__labels").alias("e"), F.size("__relations").alias("r")))
    ids = running_totals(sizes, key, {"__doc": F.lit(1), "__e": F.col("e"), "__r": F.col("r")})

    def entity_at(rid: Column) -> Column:
        # The last annotation of an id counts.
        hits = F.transform(F.col("__labels"), lambda x, i: F.when(x["rid"] == rid, i))
        return F.col("__e") + F.array_max(hits) + 1

    joined = base.join(ids, key)
    return joined.select(
        key,
        (F.col("__doc") + 1).alias("id"),
        "text",
        F.transform(
            F.col("__labels"),
            lambda x, i: F.struct(
                (F.col("__e") + i + 1).alias("id"), x["label"].alias("label"), x["start"].alias("start_offset"), x["end"].alias("end_offset")
            ),
        ).cast(ENTITIES).alias("entities"),
        F.transform(
            F.col("__relations"),
            lambda x, i: F.struct((F.col("__r") + i + 1).alias("id"), entity_at(x["f"]).alias("from_id"), entity_at(x["t"]).alias("to_id"), x["type"].alias("type")),
        ).cast(RELATIONS).alias("relations"),
    )


def annotation_choices(df: DataFrame, text: str = "data.jfull_compress", index: int = 0) -> DataFrame:
    """The first result's choices of each document as ``text, label``."""
    result = F.get(F.col("annotations"), F.lit(index))["result"]
    return df.select("*", F.col(text).alias("text"), F.get(result, F.lit(0))["value"]["choices"].alias("label"))


def named_entities(df: DataFrame, text: str = "text", entities: str = "entities", separator: str = LABEL_SEPARATOR) -> DataFrame:
    """Add ``names``: the entities with their text, label proper and class labels."""
    named = F.transform(
        F.col(entities),
        lambda e: let(
            split_class_labels(e["label"], separator),
            lambda s: F.struct(
                e["id"].alias("id"), slice_of(F.col(text), e["start_offset"], e["end_offset"]).alias("name"),
                e["start_offset"].alias("start"), e["end_offset"].alias("end"), s["entity"].alias("label"), s["classes"].alias("classes"),
            ),
        ),
    )
    return df.withColumn("names", named)


def resolved_relations(df: DataFrame, relations: str = "relations", lang: str = "ch", strict: bool = False) -> DataFrame:
    """Add ``triples``: each relation with its subject and object entity and its two prompts.

    Ids are resolved inside the document; the last entity of an id counts. A relation without a label, or with an end
    that is no entity, makes no triple and gives its document a ``reject_reason``; with ``strict`` it stops the job.
    """

    def entity(i: Column) -> Column:
        return F.try_element_at(F.filter(F.col("names"), lambda n: n["id"] == i), F.lit(-1))

    def triple(r: Column) -> Column:
        return let(
            F.struct(entity(r["from_id"]).alias("s"), entity(r["to_id"]).alias("o"), r["type"].alias("p")),
            lambda x: F.struct(
                x["s"]["name"].alias("subject"), x["p"].alias("predicate"), x["o"]["name"].alias("object"),
                x["o"]["start"].alias("start"), x["o"]["end"].alias("end"),
                relation_prompt(x["s"]["name"], x["p"], lang).alias("prompt"),
                relation_prompt(x["o"]["name"], x["p"], lang).alias("inverse"),
            ),
        )

    def split(all_of: Column) -> Column:
        whole = F.filter(all_of, lambda t: t["subject"].isNotNull() & t["object"].isNotNull() & t["predicate"].isNotNull())
        reason = F.when(F.exists(all_of, lambda t: t["predicate"].isNull()), F.lit("relation without a label"))
        reason = F.coalesce(reason, F.when(F.size(whole) < F.size(all_of), F.lit("relation to an unknown entity")))
        return F.struct(whole.alias("triples"), reason.alias("reason"))

    found = df.withColumn("__t", let(F.transform(F.col(relations), triple), split)).withColumn("triples", F.col("__t.triples"))
    earlier = F.col(REASON) if REASON in df.columns else F.lit(None).cast("string")
    return stop_on(found.withColumn(REASON, F.coalesce(earlier, F.col("__t.reason"))).drop("__t"), strict)


def resolve_relations(relations: DataFrame, entities: DataFrame, doc: str = "doc_id", order: str = "ord") -> DataFrame:
    """The same for long tables: two equi joins on (document, entity id).

    Of entities with one id the last counts, by the column ``order``; a table without it is ordered by start. A relation with an unknown end or without a label stays,
    with a ``reject_reason``.
    """
    last = F.max(F.struct(*([order] if order in entities.columns else []), "start", "end", "name"))
    e = entities.groupBy(doc, "id").agg(last.alias("x")).select(doc, "id", "x.name", "x.start", "x.end")
    subject = e.select(doc, F.col("id").alias("from_id"), F.col("name").alias("subject"))
    obj = e.select(doc, F.col("id").alias("to_id"), F.col("name").alias("object"), "start", "end")
    joined = relations.join(subject, [doc, "from_id"], "left").join(obj, [doc, "to_id"], "left")
    unlabelled = F.col("type").isNull() if "type" in relations.columns else F.lit(False)
    reason = F.when(unlabelled, F.lit("relation without a label")).when(F.col("subject").isNull() | F.col("object").isNull(), F.lit("relation to an unknown entity"))
    return joined.withColumn(REASON, reason)


def _grouped(items: Column, key: str) -> Column:
    """Group structs of (key, text, start, end) by key, in order of first occurrence."""


    def groups(c: Column) -> Column:
        return F.transform(
            F.array_distinct(F.transform(c, lambda x: x[key])),
            lambda k: F.struct(
                k.alias("prompt"),
                F.transform(
                    F.filter(c, lambda x: x[key] == k),
                    lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["end"].alias("end")),
                ).cast(PLAIN_SPANS).alias("result_list"),
            ),
        )

    return let(items, groups)


def _entity_items() -> Column:
    items = F.transform(
        F.col("names"), lambda n: F.struct(n["label"].alias("k"), n["name"].alias("text"), n["start"].alias("start"), n["end"].alias("end"))
    )
    return _grouped(items, "k")


def _relation_items() -> Column:
    items = F.transform(
        F.col("triples"), lambda t: F.struct(t["prompt"].alias("k"), t["object"].alias("text"), t["start"].alias("start"), t["end"].alias("end"))
    )
    return _grouped(items, "k")


def _aspect_items(key: str, text: str, prefix: str, options: Sequence[str], lang: str, seed: int | str | None) -> Column:
    link = F.lit(SUBJECT_LINK[lang])

    def example(n: Column, i: Column) -> Column:
        head = F.concat(n["name"], link, F.lit(prefix)) if lang == "ch" else F.concat(F.lit(prefix), link, n["name"])
        built = classification_example(F.col(text), n["classes"], head, options, seed, [F.col(key), i])
        shown = let(built, lambda x: F.struct(x["prompt"].alias("prompt"), x["result_list"].cast(PLAIN_SPANS).alias("result_list")))
        return F.when(n["classes"].isNotNull(), shown)

    return F.filter(F.transform(F.col("names"), example), lambda x: x.isNotNull())


def _explode_items(df: DataFrame, key: str, text: str, items: Column) -> DataFrame:
    return df.select(key, F.col(text).alias("content"), F.inline(items))


def entity_examples(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One example per document and entity label present."""
    return _explode_items(df, key, text, _entity_items())


def relation_examples(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One example per document and relation prompt, with all its objects."""
    return _explode_items(df, key, text, _relation_items())


def aspect_examples(
    df: DataFrame,
    key: str,
    text: str = "text",
    prefix: str = PROMPT_PREFIX,
    options: Sequence[str] = tuple(PROMPT_OPTIONS),
    lang: str = "ch",
    seed: int | str | None = SEED,
) -> DataFrame:
    """One classification example per entity that carries class labels."""
    return _explode_items(df, key, text, _aspect_items(key, text, prefix, options, lang, seed))


def classification_examples(
    df: DataFrame,
    key: str,
    text: str = "text",
    label: str = "label",
    prefix: str = PROMPT_PREFIX,
    options: Sequence[str] = tuple(PROMPT_OPTIONS),
    seed: int | str | None = SEED,
) -> DataFrame:
    """One classification example per document from its chosen labels."""
    example = classification_example(F.col(text), F.col(label), prefix, options, seed, [F.col(key)])
    return df.select(key, example.alias("x")).select(key, "x.content", "x.prompt", F.col("x.result_list").cast(PLAIN_SPANS).alias("result_list"))


def corpus_facts(docs: DataFrame, key: str) -> DataFrame:
    """What negatives need to know of a document: short strings, none of its text."""
    return docs.select(
        key,
        F.array_compact(F.array_distinct(F.transform("names", lambda n: n["label"]))).alias("labels"),
        F.array_compact(F.array_distinct(F.transform("names", lambda n: n["name"]))).alias("entity_names"),
        F.array_distinct(F.transform("triples", lambda t: t["subject"])).alias("subjects"),
        F.transform("triples", lambda t: t["predicate"]).alias("predicates"),
        F.transform("triples", lambda t: t["inverse"]).alias("inverse"),
        F.array_distinct(F.transform("triples", lambda t: t["prompt"])).alias("prompts"),
    )


def corpus_values(df: DataFrame, values: Column) -> DataFrame:
    """The distinct values of a per-document array over the corpus; combines before the shuffle."""
    return df.select(F.explode(F.array_distinct(values)).alias("value")).distinct()


def build_extraction_examples(
    df: DataFrame,
    key: str,
    negative_ratio: int = NEGATIVE_RATIO,
    prefix: str = PROMPT_PREFIX,
    options: Sequence[str] = tuple(PROMPT_OPTIONS),
    separator: str = LABEL_SEPARATOR,
    is_train: bool = True,
    lang: str = "ch",
    seed: int | str = SEED,
    text: str = "text",
) -> DataFrame:
    """Entity, relation and aspect examples with their negatives: ``key, kind, content, prompt, result_list``.

    Input: ``key, text, entities, relations``. ``negative_ratio`` -1 keeps all negatives.
    """
    docs = resolved_relations(named_entities(df, text, separator=separator), lang=lang)
    facts = durable(corpus_facts(docs, key))
    sets = {"labels": F.col("labels"), "predicates": F.col("predicates")}
    if is_train:
        sets["names"] = F.col("entity_names")
    indexes = corpus_indexes(facts, sets, seed)
    labels, predicates = indexes["labels"], indexes["predicates"]
    kinds = {
        "entity": _entity_items(),
        "relation": _relation_items(),
        "aspect": _aspect_items(key, text, prefix, options, lang, seed),
    }
    # All positives of a document in one pass over its text.
    tagged = [
        F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), x["prompt"].alias("prompt"), x["result_list"].alias("result_list")))
        for kind, items in kinds.items()
    ]
    positives = _explode_items(docs, key, text, F.concat(*tagged))
    negatives = entity_negatives(facts, labels, key, negative_ratio, seed).withColumn("kind", F.lit("entity"))
    if predicates.size:
        if is_train:
            related = train_relation_negatives(facts, indexes["names"], labels, key, negative_ratio, lang, seed).select(key, "prompt")
        else:
            related = full_relation_negatives(facts, predicates, key, lang)
        negatives = negatives.unionByName(related.withColumn("kind", F.lit("relation")))
    columns = [key, "kind", "content", "prompt", "result_list"]
    # Only prompts and keys moved so far; the text is attached once.
    attached = negatives.join(df.select(key, F.col(text).alias("content")), key).withColumn("result_list", F.array().cast(PLAIN_SPANS))
    return attached.select(*columns).unionByName(positives.select(*columns))


# --- label examples -------------------------------------------------------------------------------


def label_examples(df: DataFrame, labels: Sequence[str], text: str = "text", names: str = "choices", separator: str = PAIR_SEPARATOR, strict: bool = False) -> DataFrame:
    """``text_a, text_b, question, choices, labels`` from documents with chosen label names."""
    pair = split_pair(F.col(text), separator)
    chosen = F.coalesce(F.col(names), F.array().cast("array<string>"))
    others = [c for c in df.columns if c not in {text, names}]
    out = df.withColumn("__p", pair).select(
        *others,
        F.col("__p.text_a").alias("text_a"),
        F.col("__p.text_b").alias("text_b"),
        F.lit("").alias("question"),
        str_array(labels).alias("choices"),
        label_indexes(chosen, labels).alias("labels"),
        known_labels(chosen, labels).alias(REASON),
    )
    return stop_on(out, strict)


def inference_rows(df: DataFrame, labels: Sequence[str], text: str = "text") -> DataFrame:
    """All columns plus ``text_a, text_b, choices`` for scoring against a vocabulary."""
    return df.select("*", F.col(text).alias("text_a"), F.lit("").alias("text_b"), str_array(labels).alias("choices"))


MIN_CHOICES = 2
MIN_CHARS = 3


def is_well_formed() -> Column:
    return F.coalesce((F.size("choices") >= MIN_CHOICES) & (F.length("text_a") >= MIN_CHARS), F.lit(False))


def standard_label_examples(df: DataFrame, is_test: bool = False) -> DataFrame:
    """Well-formed examples with defaults filled in and multi-hot labels; five standard columns unless testing."""
    out = df.where(is_well_formed())
    if "text_b" not in out.columns:
        out = out.withColumn("text_b", F.lit(None).cast("string"))
    out = out.withColumn("text_b", F.coalesce("text_b", F.lit("")))
    if "labels" in out.columns:
        kind = out.schema["labels"].dataType.typeName()
        if kind == "string":
            as_list = F.coalesce(F.from_json("labels", "array<int>"), F.array(F.col("labels").try_cast("int")))
        elif kind == "array":
            as_list = F.col("labels").cast("array<int>")
        else:
            as_list = F.array(F.col("labels").cast("int"))
        out = out.withColumn("labels", F.when(F.col("labels").isNotNull(), multi_hot(as_list, F.size("choices"))))
    if is_test:
        return out
    return out.select(*[c for c in ("text_a", "text_b", "question", "choices", "labels") if c in out.columns])


def skipped_examples(df: DataFrame) -> DataFrame:
    """One row: kept and skipped examples."""
    ok = is_well_formed()
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("skipped"))
