"""Explicit schemas of every external layout, as DDL, and of the span arrays used inside."""

SPAN = "STRUCT<entity: STRING, ord: INT, `start`: INT, `end`: INT, text: STRING, probability: DOUBLE>"
SPANS = f"ARRAY<{SPAN}>"
PLAIN_SPANS = "ARRAY<STRUCT<text: STRING, `start`: INT, `end`: INT>>"
SCORED_SPANS = "ARRAY<STRUCT<text: STRING, `start`: INT, `end`: INT, probability: DOUBLE>>"

ANNOTATION_RESULT = (
    "STRUCT<id: STRING, type: STRING, from_name: STRING, to_name: STRING, origin: STRING, "
    "value: STRUCT<`start`: INT, `end`: INT, text: STRING, labels: ARRAY<STRING>, choices: ARRAY<STRING>>, "
    "from_id: STRING, to_id: STRING, labels: ARRAY<STRING>>"
)

ANNOTATED = (
    "id BIGINT, "
    "data STRUCT<jfull_compress: STRING, text: STRING, jid: STRING>, "
    f"annotations ARRAY<STRUCT<id: BIGINT, completed_by: STRING, result: ARRAY<{ANNOTATION_RESULT}>>>"
)

VERDICT = (
    "level_0 BIGINT, `index` BIGINT, id BIGINT, jid STRING, jyear STRING, jcase STRING, jno STRING, "
    "jdate_dt BIGINT, jtitle STRING, jtype STRING, jfull_compress STRING, litigation_type STRING, "
    "etl_datetime BIGINT, source_id BIGINT, source_cnt BIGINT, source_id_v2 BIGINT, source_cnt_v2 BIGINT"
)

PROMPT_EXAMPLE = f"content STRING, result_list {PLAIN_SPANS}, prompt STRING"

# ``labels`` is read as text because it may be a scalar or a list.
LABEL_EXAMPLE_RAW = "text_a STRING, text_b STRING, question STRING, choices ARRAY<STRING>, labels STRING"

INFERENCE_RESULTS = f"ARRAY<MAP<STRING, {SCORED_SPANS}>>"

ENTITIES = "ARRAY<STRUCT<id: BIGINT, label: STRING, start_offset: INT, end_offset: INT>>"
RELATIONS = "ARRAY<STRUCT<id: BIGINT, from_id: BIGINT, to_id: BIGINT, type: STRING>>"

# ``label`` is read as text because its layout differs between exports.
CORPUS_EXPORT_RAW = f"id BIGINT, data STRING, text STRING, label STRING, entities {ENTITIES}, relations {RELATIONS}"
CORPUS_LABEL_OBJECT = f"STRUCT<entities: {ENTITIES}, relations: {RELATIONS}>"
