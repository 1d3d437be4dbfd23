"""SQL equivalents of the registered queries, over the same tables and with the same column names."""

from __future__ import annotations

from .queries import BUDGET, CHUNK_LEN, ENTITY_NAMES, LABELS, N_DIMS, NUMBER, NUMBER_LINE, OVERLAP_CHUNK, PATTERNS, SHORT_CHUNK


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def hits_of(entities: list[tuple[str, str]], source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """Matches of several patterns with offsets: ``key, e_no, entity, ord, start, end, text``."""
    parts = [
        f"SELECT {key}, {n} AS e_no, {quote(e)} AS entity, regexp_extract_all({text}, {quote(p)}) AS m, "
        f"regexp_split_to_array({text}, {quote(p)}) AS s FROM {source}"
        for n, (e, p) in enumerate(entities)
    ]
    return (
        f"SELECT {key}, e_no, entity, i AS ord, p0 AS start, p0 + length(t) AS \"end\", t AS text FROM ("
        f"SELECT {key}, e_no, entity, i, m[i + 1] AS t, "
        "list_sum(list_transform(s[1:i + 1], lambda x: length(x)))::BIGINT + "
        "coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0)::BIGINT AS p0 "
        f"FROM (SELECT {key}, e_no, entity, m, s, unnest(range(len(m))) AS i FROM ({' UNION ALL '.join(parts)})))"
    )


STAND_IN = "((start * 7 + (\"end\" - start) * 13) % 100) / 100.0::DOUBLE"
RULE_PAIRS = list(PATTERNS.items())
SPANS = f"spans AS (SELECT *, {STAND_IN} AS probability FROM ({hits_of(RULE_PAIRS)}))"
NUMBERED = f"spans AS (SELECT *, {STAND_IN} AS probability FROM ({hits_of(RULE_PAIRS + [('number', NUMBER)])}))"
ROW = 'doc_id, entity, ord, start, "end", text, probability'
NAMES = "(VALUES " + ", ".join(f"({n}, {quote(e)})" for n, e in enumerate(ENTITY_NAMES)) + ") AS n(e_no, entity)"

SPECIALS = "chr(10) || ' ' || chr(12288)"
CLEANED = f"replace(translate(text, {SPECIALS}, ''), '\\n', '')"
BLANKS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)||chr(5760)" + "".join(
    f"||chr({c})" for c in (*range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


def ranked(condition: str = "TRUE") -> str:
    return (
        f"SELECT {ROW} FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, entity ORDER BY probability DESC, ord) AS rn "
        f"FROM spans WHERE {condition}) WHERE rn = 1"
    )


def hash_of(seed: str, *keys: str) -> str:
    return "md5(" + " || ':' || ".join([quote(seed), *[f"({k})::VARCHAR" for k in keys]]) + ")"


def hash_mod(seed: str, size: str, *keys: str) -> str:
    return f"(('0x' || substr({hash_of(seed, *keys)}, 1, 15))::BIGINT % ({size})::BIGINT)"


SQL: dict[str, str] = {}

SQL["clean_text"] = (
    f"SELECT doc_id, md5({CLEANED}) AS clean_md5, length({CLEANED})::BIGINT AS clean_len, contains(text, chr(12288)) AS fullwidth FROM documents"
)

# --- regularising -----------------------------------------------------------------------------------

def moved(planted: bool = False) -> str:
    """Spans of cleaned texts; planted: of every seventh document the first span has another text."""
    text = "replace(translate(h.text, {S}, ''), '\\n', '')"
    if planted:
        text += " || CASE WHEN h.doc_id % 7 = 3 AND row_number() OVER (PARTITION BY h.doc_id ORDER BY e_no, ord) = 1 THEN 'x' ELSE '' END"
    return (
        f"WITH hits AS ({hits_of(RULE_PAIRS + [('line', NUMBER_LINE)])}), "
        "d AS (SELECT doc_id, text AS raw, translate(text, {S}, '') AS short FROM documents), "
        "n AS (SELECT h.doc_id, e_no, entity, ord, "
        "start - (length(substr(raw, 1, start)) - length(translate(substr(raw, 1, start), {S}, ''))) AS start, "
        "\"end\" - (length(substr(raw, 1, \"end\" - 1)) - length(translate(substr(raw, 1, \"end\" - 1), {S}, ''))) AS \"end\", "
        f"{text} AS text, short FROM hits h JOIN d USING (doc_id)), "
        "c AS (SELECT *, substr(short, start + 1, \"end\" - start) <> text AS bad FROM n), "
        "f AS (SELECT *, bool_or(bad) OVER (PARTITION BY doc_id) AS reject FROM c) "
    ).replace("{S}", SPECIALS)


SQL["regularize_spans"] = moved() + 'SELECT doc_id, entity, ord, start, "end", text FROM f WHERE NOT reject'
SQL["regularize_rejects"] = moved(planted=True) + (
    "SELECT doc_id, 'slice [' || start || ',' || \"end\" || ') differs from span text' AS reason FROM "
    "(SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY e_no, ord) AS rn FROM f WHERE bad) WHERE rn = 1"
)

# --- extraction and selection -----------------------------------------------------------------------

SQL["extract_spans"] = f"WITH {SPANS} SELECT {ROW} FROM spans"

_SHOW = 'entity, ord, start, "end", text, 0.5::DOUBLE AS probability'
SQL["extract_two_stage"] = (
    f"WITH a AS ({hits_of([('address', PATTERNS['email'])])}), b AS ({hits_of([('address', NUMBER)])}), "
    f"c AS ({hits_of([('first_card', PATTERNS['card'])])}), e AS ({hits_of([('first_card', PATTERNS['phone'])])}) "
    f"SELECT doc_id, {_SHOW} FROM a "
    f"UNION ALL SELECT doc_id, {_SHOW} FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a) "
    "UNION ALL SELECT doc_id, 'address', 0, 0, 1, 'none', 0.5 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM a UNION SELECT doc_id FROM b) "
    f"UNION ALL SELECT doc_id, {_SHOW} FROM c WHERE ord = 0 "
    f"UNION ALL SELECT doc_id, {_SHOW} FROM e WHERE doc_id NOT IN (SELECT doc_id FROM c)"
)

_CASES = (
    "cases AS (SELECT o_orderkey AS order_id, "
    "CASE WHEN o_orderkey % 4 = 0 THEN '原告現年' || (o_custkey % 90) || '歲，' WHEN o_orderkey % 4 = 1 THEN '原告為退休人員，' "
    "WHEN o_orderkey % 4 = 2 THEN '原告於民國五十年出生，' ELSE '原告' || o_custkey || '，' END || "
    "CASE WHEN o_orderkey % 3 = 0 THEN '被告負百分之' || (o_orderkey % 100) || '過失責任，' WHEN o_orderkey % 3 = 1 THEN '被告有過失，肇事逃逸，' "
    "ELSE '雙方無爭執，' END || "
    "CASE WHEN o_orderkey % 5 = 0 THEN '受有頭部' || o_orderpriority || '傷害，又受有腿部傷害。' WHEN o_orderkey % 5 = 1 THEN '受有傷。' "
    "WHEN o_orderkey % 5 = 2 THEN '受有輕微的傷勢。' ELSE '。' END AS text FROM orders)"
)
_CASE_RULES = [
    ("age", ".[^65]歲|出生|年.{0,5}[^發|^產]生|年次|年紀", "歲|退休|學生|小學|國中|高中|大學|研究所|畢業|未成年|原告.{0,15}年\\}", False),
    (
        "fault",
        "|".join(f"{m}.{{0,20}}{c}|{c}.{{0,20}}{m}" for m in ("%", "分之", "％", "/") for c in ("過失", "責任", "肇事")),
        "比例|%|肇事|責任|過失|％|[^部]分之",
        False,
    ),
    ("injury", "受有.{0,100}傷害|受有.{0,100}傷勢", "受有|傷", True),
]
_case_parts = []
for _n, (_name, _first, _second, _one) in enumerate(_CASE_RULES):
    _show = 'order_id, entity, ord, start, "end", text, 0.5::DOUBLE AS probability'
    _case_parts.append(f"a{_n} AS ({hits_of([(_name, _first)], 'cases', 'order_id')}), b{_n} AS ({hits_of([(_name, _second)], 'cases', 'order_id')})")
SQL["case_rules"] = f"WITH {_CASES}, {', '.join(_case_parts)} " + " UNION ALL ".join(
    f"SELECT {_show} FROM a{n}{' WHERE ord = 0' if r[3] else ''} UNION ALL SELECT {_show} FROM b{n} WHERE order_id NOT IN (SELECT order_id FROM a{n}) "
    f"UNION ALL SELECT order_id, {quote(r[0])}, 0, 0, 1, '預設輸出', 0.5 FROM cases WHERE order_id NOT IN (SELECT order_id FROM a{n} UNION SELECT order_id FROM b{n})"
    for n, r in enumerate(_CASE_RULES)
)

SQL["model_then_rules"] = (
    f"WITH {SPANS}, num AS ({hits_of([('ip', NUMBER)])}), ph AS ({hits_of([('phone', PATTERNS['phone'])])}) "
    f"SELECT {ROW} FROM spans WHERE entity IN ('ip', 'email') "
    f"UNION ALL SELECT doc_id, {_SHOW} FROM num WHERE doc_id NOT IN (SELECT doc_id FROM spans WHERE entity = 'ip') "
    f"UNION ALL SELECT doc_id, {_SHOW} FROM ph"
)
SQL["strategy_all"] = SQL["extract_spans"]
SQL["strategy_threshold"] = f"WITH {SPANS} SELECT {ROW} FROM spans WHERE probability > 0.5"
SQL["strategy_max"] = f"WITH {SPANS} {ranked()}"
SQL["top_span_long"] = SQL["strategy_max"]
_FILLED = "SELECT d.doc_id, n.entity, 0 AS ord, -1 AS start, -1 AS \"end\", 'nan' AS text, 0.0 AS probability"
_MISSING = f"FROM documents d CROSS JOIN {NAMES} WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = d.doc_id AND s.entity = n.entity)"
SQL["filled_spans"] = f"WITH {SPANS} SELECT {ROW} FROM spans UNION ALL {_FILLED} {_MISSING}"
SQL["kept_keys"] = (
    f"WITH {SPANS} SELECT doc_id, entity, string_agg(text || ':' || start, '|' ORDER BY ord) AS kept FROM spans GROUP BY doc_id, entity"
)
_FLAT = ", ".join(
    f"coalesce(max(CASE WHEN b.entity = '{e}' THEN b.text END), 'nan') AS \"{e}\", "
    + ", ".join(
        f"coalesce(max(CASE WHEN b.entity = '{e}' THEN b.\"{k}\" END), {d}) AS \"uie_result_{n}_for_{e}\""
        for k, n, d in (("start", "start_index", "-1"), ("end", "end_index", "-1"), ("probability", "probability", "0.0"))
    )
    for e in ENTITY_NAMES
)
SQL["flat_entity_table"] = (
    f"WITH {SPANS}, best AS ({ranked()}) SELECT d.doc_id, {_FLAT} FROM documents d LEFT JOIN best b USING (doc_id) GROUP BY d.doc_id"
)
_CLEAN_SPANS = f"clean AS (SELECT doc_id, {CLEANED} AS text FROM documents), spans AS (SELECT *, 0.5::DOUBLE AS probability FROM ({hits_of(RULE_PAIRS, 'clean')}))"
SQL["extract_to_table"] = (
    f"WITH {_CLEAN_SPANS}, best AS ({ranked()}) SELECT d.doc_id, "
    + ", ".join(
        f"coalesce(max(CASE WHEN b.entity = '{e}' THEN b.text END), 'nan') AS \"{e}\", "
        f"coalesce(max(CASE WHEN b.entity = '{e}' THEN b.start END), -1) AS \"uie_result_start_index_for_{e}\""
        for e in ENTITY_NAMES
    )
    + " FROM documents d LEFT JOIN best b USING (doc_id) GROUP BY d.doc_id"
)
SQL["span_rows_ge_threshold"] = f"WITH {SPANS} SELECT {ROW} FROM spans WHERE probability >= 0.5"
SQL["annotation_export"] = (
    f"WITH {SPANS}, s AS (SELECT doc_id, count(*) AS n, string_agg(entity || ':' || start || ':' || \"end\" || ':' || "
    "substr(md5(doc_id || ':' || entity || ':' || start || ':' || \"end\"), 1, 10) || ':labels', '|' ORDER BY e_no, ord) AS result "
    "FROM spans WHERE probability >= 0.5 GROUP BY doc_id) "
    "SELECT (row_number() OVER (ORDER BY d.doc_id) - 1)::BIGINT AS id, md5(d.text) AS text_md5, 'reviewer@example.com' AS mail, "
    "coalesce(s.n, 0)::BIGINT AS n_results, coalesce(s.result, '') AS result FROM documents d LEFT JOIN s USING (doc_id)"
)

# --- examples and chunks ----------------------------------------------------------------------------

SQL["prompt_examples"] = (
    f"WITH {SPANS}, g AS (SELECT doc_id, entity, count(*) AS n, string_agg(start || ':' || \"end\" || ':' || text, '|' ORDER BY start) AS result "
    "FROM spans GROUP BY doc_id, entity) "
    "SELECT d.doc_id, n.entity AS prompt, length(d.text)::BIGINT AS content_len, coalesce(g.n, 0)::BIGINT AS n_spans, coalesce(g.result, '') AS result "
    f"FROM documents d CROSS JOIN {NAMES} LEFT JOIN g ON g.doc_id = d.doc_id AND g.entity = n.entity"
)


def chunked(max_len: int, entities: list[tuple[str, str]], lenient: bool = False, overlaps: bool = False) -> str:
    """Greedy walk over each (document, prompt): ``doc_id, prompt, no, cs, ce, body, sp`` and a table of rejects."""
    names = "(VALUES " + ", ".join(f"({quote(e)})" for e, _ in entities) + ") AS n(prompt)"
    strip = f"trim(text, {BLANKS})"
    lead = f"(length(text) - length(ltrim(text, {BLANKS})))"
    passes = f"length({strip}) <= {max_len} - 3 - length(prompt)" if lenient else "FALSE"
    drop = "WHERE \"end\" - start <= cap" if lenient else ""
    found = f"spans AS ({hits_of(entities)})"
    if overlaps:
        shifted = 'h.start + (h."end" - h.start) // 2'
        found = (
            f"hits AS ({hits_of(entities)}), spans AS (SELECT doc_id, e_no, entity, ord, start, \"end\", text FROM hits UNION ALL "
            f"SELECT h.doc_id, e_no, entity, ord, {shifted}, h.\"end\" + 3, substr(d.text, {shifted} + 1, h.\"end\" + 3 - ({shifted})) "
            f"FROM hits h JOIN documents d USING (doc_id) WHERE h.\"end\" + 3 <= length(rtrim(d.text, {BLANKS})))"
        )
    return (
        f"RECURSIVE {found}, "
        f"base AS (SELECT doc_id, prompt, {max_len} - 3 - length(prompt) AS cap, {passes} AS pass, "
        f"CASE WHEN {passes} THEN text ELSE {strip} END AS body, CASE WHEN {passes} THEN 0 ELSE {lead} END AS shift FROM documents, {names}), "
        "placed AS (SELECT b.doc_id, b.prompt, list({'a': s.start - shift, 'b': s.\"end\" - shift, 't': s.text} ORDER BY s.start) AS sp, "
        'bool_or(s."end" - s.start > cap) AS too_long, count(*) FILTER (WHERE s."end" - s.start > cap) AS n_long '
        "FROM base b JOIN spans s ON s.doc_id = b.doc_id AND s.entity = b.prompt GROUP BY ALL), "
        "full_rows AS (SELECT b.*, coalesce("
        + ("list_filter(p.sp, lambda x: x.b - x.a <= cap)" if lenient else "p.sp")
        + ", []) AS sp, coalesce(p.too_long, FALSE) AS too_long, coalesce(p.n_long, 0) AS n_long FROM base b LEFT JOIN placed p USING (doc_id, prompt)), "
        "walk AS (SELECT doc_id, prompt, cap, pass, length(body) AS len, sp, 0 AS no, 0::BIGINT AS cs, "
        "CASE WHEN pass THEN length(body) ELSE coalesce(list_min(list_transform(list_filter(sp, lambda x: x.a > 0 AND x.a < cap AND x.b > cap), lambda x: x.a)), least(cap, length(body))) END::BIGINT AS ce "
        f"FROM full_rows WHERE {'TRUE' if lenient else 'NOT too_long AND length(body) > 0'} "
        "UNION ALL SELECT doc_id, prompt, cap, pass, len, sp, no + 1, ce, "
        "coalesce(list_min(list_transform(list_filter(sp, lambda x: x.a > ce AND x.a < ce + cap AND x.b > ce + cap), lambda x: x.a)), least(ce + cap, len))::BIGINT "
        "FROM walk WHERE ce < len), "
        "pieces AS (SELECT w.doc_id, w.prompt, no, cs, ce, substr(body, cs + 1, ce - cs) AS content, n_long, "
        "list_filter(w.sp, lambda x: x.a >= cs AND x.a < ce) AS inside FROM walk w JOIN full_rows USING (doc_id, prompt)) "
    )


SQL["chunk_examples"] = "WITH " + chunked(CHUNK_LEN, RULE_PAIRS) + (
    "SELECT doc_id, prompt, no::BIGINT AS chunk_no, cs AS chunk_start, length(content)::BIGINT AS chunk_len, md5(content) AS content_md5, "
    "len(inside)::BIGINT AS n_spans FROM pieces"
)
SQL["chunk_spans"] = "WITH " + chunked(CHUNK_LEN, RULE_PAIRS) + (
    "SELECT doc_id, prompt, no::BIGINT AS chunk_no, x.t AS text, (x.a - cs)::BIGINT AS start, (x.b - cs)::BIGINT AS \"end\" "
    "FROM (SELECT doc_id, prompt, no, cs, unnest(inside) AS x FROM pieces)"
)
SQL["chunk_rejects"] = "WITH " + chunked(SHORT_CHUNK, RULE_PAIRS) + (
    "SELECT doc_id, prompt, 'span longer than a chunk' AS reason FROM full_rows WHERE too_long"
)
SQL["chunk_overlaps"] = "WITH " + chunked(OVERLAP_CHUNK, RULE_PAIRS, overlaps=True) + (
    ", shown AS (SELECT doc_id, prompt, no, cs, ce, inside, list_bool_or(list_transform(inside, lambda x: x.b > ce)) AS through FROM pieces), "
    "cut AS (SELECT doc_id, prompt, bool_or(coalesce(through, FALSE)) AS through, count(*) AS n_chunks, sum(len(inside)) AS n_spans, "
    "string_agg(cs || ':' || (ce - cs) || ':' || array_to_string(list_transform(inside, lambda x: (x.a - cs) || ':' || (x.b - cs) || ':' || x.t), '|'), '|' ORDER BY no) AS pieces "
    "FROM shown GROUP BY doc_id, prompt) "
    "SELECT f.doc_id, f.prompt, CASE WHEN too_long THEN 'span longer than a chunk' WHEN through THEN 'a cut goes through a span' END AS reason, "
    "(CASE WHEN too_long OR through THEN 1 ELSE n_chunks END)::BIGINT AS n_chunks, len(sp)::BIGINT AS n_spans, "
    "md5(CASE WHEN too_long OR through THEN '0:' || length(body) || ':' || array_to_string(list_transform(sp, lambda x: x.a || ':' || x.b || ':' || x.t), '|') ELSE pieces END) AS pieces_md5 "
    "FROM full_rows f LEFT JOIN cut USING (doc_id, prompt) WHERE length(body) > 0 OR too_long"
)
SQL["chunk_by_prompt"] = "WITH " + chunked(CHUNK_LEN, RULE_PAIRS) + (
    "SELECT doc_id, prompt, count(*) AS n_chunks, sum(length(content))::BIGINT AS chars, sum(len(inside))::BIGINT AS n_spans FROM pieces GROUP BY doc_id, prompt"
)
SQL["chunk_lenient"] = "WITH " + chunked(64, RULE_PAIRS, lenient=True) + (
    "SELECT doc_id, prompt, no::BIGINT AS chunk_no, cs AS chunk_start, md5(content) AS content_md5, "
    "array_to_string(list_transform(inside, lambda x: (x.a - cs) || ':' || (x.b - cs) || ':' || x.t), '|') AS result, n_long::BIGINT AS n_dropped FROM pieces"
)
SQL["token_align"] = "WITH " + chunked(CHUNK_LEN, RULE_PAIRS) + (
    "SELECT doc_id, prompt, no::BIGINT AS chunk_no, (length(prompt) + 1)::BIGINT AS drift, (x.a - cs)::BIGINT AS start, (x.b - cs)::BIGINT AS \"end\", "
    "(x.a - cs + length(prompt) + 2)::BIGINT AS first_token, (x.b - cs + length(prompt) + 1)::BIGINT AS last_token "
    "FROM (SELECT doc_id, prompt, no, cs, unnest(inside) AS x FROM pieces)"
)
SQL["position_vectors"] = "WITH " + chunked(CHUNK_LEN, RULE_PAIRS) + (
    f"SELECT doc_id, prompt, no::BIGINT AS chunk_no, {CHUNK_LEN}::BIGINT AS length, "
    "array_to_string(list_transform(inside, lambda x: x.a - cs + length(prompt) + 2), ',') AS starts, "
    "array_to_string(list_transform(inside, lambda x: x.b - cs + length(prompt) + 1), ',') AS ends FROM pieces"
)
SQL["model_window_spans"] = (
    f"WITH spans AS ({hits_of([('digits', '[0-9]+'), ('capitals', '[A-Z]+')])}) SELECT doc_id, entity, "
    "row_number() OVER (PARTITION BY doc_id, entity ORDER BY start) - 1 AS ord, start, \"end\", text, 1.0::DOUBLE AS probability FROM spans WHERE \"end\" - start < 40"
)
SQL["pad_bucket"] = (
    "SELECT doc_id, CASE WHEN length(text) + 3 <= 128 THEN 128 WHEN length(text) + 3 <= 256 THEN 256 WHEN length(text) + 3 <= 512 THEN 512 "
    "WHEN length(text) + 3 <= 1024 THEN 1024 ELSE 512 END::BIGINT AS bucket FROM documents"
)

# --- shrinking --------------------------------------------------------------------------------------

_KEPT = (
    f"RECURSIVE {NUMBERED}, "
    "cand AS (SELECT doc_id, list({'entity': entity, 'ord': ord, 'a': start, 'b': \"end\", 't': text, 'p': probability} ORDER BY e_no, ord) AS c "
    "FROM spans WHERE probability > 0.4 GROUP BY doc_id), "
    "pick AS (SELECT doc_id, c, 1 AS i, [c[1]] AS kept FROM cand UNION ALL "
    "SELECT doc_id, c, i + 1, CASE WHEN list_contains(list_transform(kept, lambda k: k.a), c[i + 1].a) OR list_contains(list_transform(kept, lambda k: k.b), c[i + 1].b) "
    "THEN kept ELSE list_append(kept, c[i + 1]) END FROM pick WHERE i < len(c)), "
    "kept AS (SELECT doc_id, kept FROM pick WHERE i = len(c))"
)
SQL["greedy_dedup"] = (
    f"WITH {_KEPT} SELECT doc_id, x.entity AS entity, x.ord AS ord, x.a AS start, x.b AS \"end\", x.t AS text, x.p AS probability "
    "FROM (SELECT doc_id, unnest(kept) AS x FROM kept)"
)


def windows(limit: str) -> str:
    return (
        "boxes AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY greatest(x.a - half, 0), pos) - 1 AS i, "
        f"greatest(x.a - half, 0)::BIGINT AS a, least(x.b + half, {limit})::BIGINT AS b, {limit} AS lim FROM ("
        "SELECT doc_id, x, pos, n, text, round_even((round_even("
        f"{BUDGET}.0::DOUBLE / n, 0) - (x.b - x.a)) / 2, 0)::BIGINT AS half FROM ("
        "SELECT doc_id, unnest(kept) AS x, generate_subscripts(kept, 1) AS pos, len(kept) AS n FROM kept) JOIN documents USING (doc_id)))"
    )


SQL["span_windows"] = f"WITH {_KEPT}, {windows('length(text)')} SELECT doc_id, i::BIGINT AS n, a AS start, b AS \"end\" FROM boxes"


def shrunk(dynamic: bool = True, compat: bool = False, kept: str = _KEPT) -> str:
    """``short(doc_id, text)``: the walk over the windows of each document."""
    widened_a = "CASE WHEN saved > 0 THEN greatest(round_even(w.a - saved / 2.0::DOUBLE, 0), 0)::BIGINT ELSE w.a END" if dynamic else "w.a"
    widened_b = "CASE WHEN saved > 0 THEN least(round_even(w.b + saved / 2.0::DOUBLE, 0), w.lim)::BIGINT ELSE w.b END" if dynamic else "w.b"
    gain = "CASE WHEN left_over > 0 THEN round_even((last - a) / left_over::DOUBLE, 0)::BIGINT ELSE last - a END"
    saved = f"CASE WHEN a < last THEN saved + {gain} ELSE saved END" if dynamic else "saved"
    stretch = "CASE WHEN a < last AND left_over = 0 THEN CASE WHEN b + saved < lim THEN b + round_even(saved / 2.0::DOUBLE, 0)::BIGINT ELSE lim END ELSE b END" if dynamic else "b"
    new_last = "e" if compat else "greatest(last, e)"
    limit = "(length(text) - 1)" if compat else "length(text)"

    def step(source: str) -> str:
        return (
            f"SELECT doc_id, n, i, {new_last} AS last, saved, list_append(cuts, {{'a': CASE WHEN a < last THEN last ELSE a END, 'b': e}}) AS cuts FROM ("
            f"SELECT *, {stretch} AS e FROM (SELECT * REPLACE ({saved} AS saved) FROM ("
            f"SELECT w.doc_id, w.n, w.i, w.lim, p.last, p.saved, p.cuts, w.n - (w.i + 1) AS left_over, {widened_a} AS a, {widened_b} AS b FROM {source})))"
        )

    first = "boxes w, (SELECT -1::BIGINT AS last, 0::BIGINT AS saved, []::STRUCT(a BIGINT, b BIGINT)[] AS cuts) p WHERE w.i = 0"
    return (
        f"WITH {kept}, {windows(limit)}, "
        f"run AS ({step(first)} UNION ALL {step('boxes w JOIN run p ON w.doc_id = p.doc_id AND w.i = p.i + 1')}), "
        "joined AS (SELECT d.doc_id, d.text AS raw, coalesce(array_to_string(list_transform(r.cuts, lambda c: substr(d.text, c.a + 1, greatest(c.b - c.a, 0))), ''), '') AS s "
        "FROM documents d LEFT JOIN run r ON r.doc_id = d.doc_id AND r.i = r.n - 1), "
        f"short AS (SELECT doc_id, raw, CASE WHEN length(s) > 0 THEN s ELSE substr(raw, 1, {BUDGET}) END AS text FROM joined) "
    )


_SHORT = "SELECT doc_id, length(text)::BIGINT AS short_len, md5(text) AS short_md5 FROM short"
SQL["shrink_documents"] = shrunk() + _SHORT
SQL["shrink_documents_compat"] = shrunk(compat=True) + _SHORT
SQL["shrink_documents_static"] = shrunk(dynamic=False) + _SHORT
SQL["two_stage_classify"] = shrunk(kept=_KEPT.replace(STAND_IN, "0.5::DOUBLE")) + (
    "SELECT doc_id, length(text)::BIGINT AS short_len, (length(text) > 100)::BIGINT AS long, contains(text, '@')::BIGINT AS address, "
    "regexp_matches(text, '[0-9]')::BIGINT AS digits FROM short"
)
SQL["row_counts"] = shrunk() + (
    "SELECT count(*) AS n_docs, sum(length(raw))::BIGINT AS chars_before, sum(length(text))::BIGINT AS chars_after, max(length(raw))::BIGINT AS longest FROM short"
)
SQL["template_budget"] = (
    "SELECT count(*) AS n_labels, (sum(1 + length(event_type)) + 4)::BIGINT AS template_len, (768 - sum(1 + length(event_type)) - 4)::BIGINT AS budget "
    "FROM (SELECT DISTINCT event_type FROM events)"
)

# --- negatives and relations ------------------------------------------------------------------------

_FACTS = (
    f"{SPANS}, facts AS (SELECT doc_id, list_distinct(list_concat([lang, source], coalesce(e, []))) AS labels FROM documents "
    "LEFT JOIN (SELECT doc_id, list(DISTINCT entity) AS e FROM spans GROUP BY doc_id) USING (doc_id))"
)
SQL["corpus_label_sets"] = f"WITH {_FACTS} SELECT DISTINCT value, length(value)::BIGINT AS n_chars FROM (SELECT unnest(labels) AS value FROM facts)"


def index_of(name: str, column: str) -> str:
    return (
        f"{name} AS (SELECT value, row_number() OVER (ORDER BY {hash_of('7', 'value')}, value) - 1 AS position FROM "
        f"(SELECT DISTINCT value FROM (SELECT unnest({column}) AS value FROM facts)))"
    )


def draw(name: str, index: str, own: str, take: str) -> str:
    """The first ``take`` values in the order of the document's permutation that the document does not have."""
    prime = (
        f"(SELECT min(p) FROM range(greatest((SELECT count(*) FROM {index}), 2), 2 * (SELECT count(*) FROM {index}) + 3) AS c(p) "
        "WHERE NOT EXISTS (SELECT 1 FROM range(2, 400) AS d(d) WHERE d * d <= p AND p % d = 0))"
    )
    return (
        f"{name}_p AS (SELECT {prime} AS p), {name} AS (SELECT * FROM (SELECT f.*, x.value, row_number() OVER (PARTITION BY f.doc_id ORDER BY f.i) AS rn FROM "
        f"(SELECT g.*, s.i, (({hash_mod('7:step', 'p - 1', 'g.doc_id')} + 1) * s.i + {hash_mod('7', 'p', 'g.doc_id')}) % p AS position "
        f"FROM facts g, {name}_p, range((SELECT p FROM {name}_p)) AS s(i)) f "
        f"JOIN {index} x ON x.position = f.position AND NOT list_contains(f.{own}, x.value)) WHERE rn <= {take})"
    )


SQL["entity_negatives"] = (
    f"WITH {_FACTS}, {index_of('idx', 'labels')}, "
    + draw(
        "drawn", "idx", "labels",
        "(CASE WHEN ceil(((SELECT count(*) FROM idx) - len(labels)) / len(labels)::DOUBLE) <= 2 THEN (SELECT count(*) FROM idx) ELSE 2 * len(labels) END)",
    )
    + " SELECT doc_id, value AS prompt FROM drawn"
)
_ALL = "[" + ", ".join(quote(e) for e in ENTITY_NAMES) + "]"
SQL["label_difference"] = (
    f"WITH {_FACTS} SELECT doc_id, array_to_string(list_sort(list_concat(list_filter(labels, lambda x: NOT list_contains({_ALL}, x)), "
    f"list_filter({_ALL}, lambda x: NOT list_contains(labels, x)))), ',') AS difference FROM facts"
)

_CORPUS = (
    "c AS (SELECT c_custkey AS doc_id, c_name AS n, n_name AS a, c_mktsegment AS s, c_acctbal AS bal, 'region_' || n_regionkey AS region, c_custkey % 3 AS k "
    "FROM customer JOIN nation ON n_nationkey = c_nationkey), "
    "ent AS (SELECT doc_id, 1 AS id, n AS name, 0 AS start, 'customer' AS label, "
    "CASE WHEN bal > 5000 THEN ['rich'] WHEN bal < 0 THEN ['poor', 'late'] END AS classes FROM c "
    "UNION ALL SELECT doc_id, 2, a, length(n) + 1, region, NULL FROM c "
    "UNION ALL SELECT doc_id, 3, s, length(n) + length(a) + 2, 'segment', NULL FROM c WHERE k = 0), "
    "rel AS (SELECT doc_id, f, t, p, i FROM c, (VALUES (1, 1, 2, 'home', 1), (0, 1, 2, 'home', 1), (0, 1, 3, 'market', 2), (0, 2, 3, 'trade', 3)) AS v(kk, f, t, p, i) WHERE k = kk), "
    "trip AS (SELECT r.doc_id, r.i, s.name AS subject, r.p AS predicate, o.name AS object, o.start AS start, o.start + length(o.name) AS \"end\", "
    "s.name || '的' || r.p AS prompt, o.name || '的' || r.p AS inverse FROM rel r JOIN ent s ON s.doc_id = r.doc_id AND s.id = r.f JOIN ent o ON o.doc_id = r.doc_id AND o.id = r.t), "
    "facts AS (SELECT c.doc_id, e.labels, e.names, coalesce(t.subjects, []) AS subjects, coalesce(t.predicates, []) AS predicates, coalesce(t.inverse, []) AS inverse, coalesce(t.prompts, []) AS prompts "
    "FROM c JOIN (SELECT doc_id, list(DISTINCT label) AS labels, list(DISTINCT name) AS names FROM ent GROUP BY doc_id) e USING (doc_id) "
    "LEFT JOIN (SELECT doc_id, list(predicate ORDER BY i) AS predicates, list(inverse ORDER BY i) AS inverse, list(DISTINCT prompt) AS prompts, "
    "CASE WHEN bool_or(predicate = 'trade') THEN [max(CASE WHEN predicate = 'home' THEN subject END), max(CASE WHEN predicate = 'trade' THEN subject END)] ELSE [max(subject)] END AS subjects "
    "FROM trip GROUP BY doc_id) t USING (doc_id))"
)
_FULL = f"{index_of('preds', 'predicates')}, full_neg AS (SELECT doc_id, s || '的' || value AS prompt FROM (SELECT doc_id, prompts, unnest(subjects) AS s FROM facts), preds WHERE NOT list_contains(prompts, s || '的' || value))"
SQL["relation_full_negatives"] = f"WITH {_CORPUS}, {_FULL} SELECT doc_id, prompt FROM full_neg"


def _first(n: str, third: int = 1) -> str:
    return f"CASE WHEN pos = 0 OR ceil({n} / pos::DOUBLE) <= {third} THEN {n} ELSE {third} * pos END"


_NAMES_N, _LABELS_N = "(SELECT count(*) FROM nidx)", "(SELECT count(*) FROM lidx)"
_POOLS = (
    f"{index_of('nidx', 'names')}, {index_of('lidx', 'labels')}, "
    f"sizes AS (SELECT doc_id, len(prompts) AS pos, len(inverse)::BIGINT AS n1, CASE WHEN len(predicates) > 0 THEN {_NAMES_N} - len(subjects) ELSE 0 END AS n2, "
    f"CASE WHEN len(subjects) > 0 THEN {_LABELS_N} - len(labels) ELSE 0 END AS n3 FROM facts), "
    f"base AS (SELECT *, {_first('n1')} AS t1, {_first('n2')} AS t2, {_first('n3')} AS t3 FROM sizes), "
    "left_over AS (SELECT *, n1 - t1 AS r1, n2 - t2 AS r2, n3 - t3 AS r3, (n1 - t1) + (n2 - t2) + (n3 - t3) AS total, greatest(5 * pos - t1 - t2 - t3, 0) AS miss FROM base), "
    "picks AS (SELECT doc_id, "
    f"list_transform(range(miss), lambda j: ({hash_mod('7:top', 'greatest(total, 1)', 'doc_id')} + (j * total) // greatest(miss, 1)) % greatest(total, 1)) AS ps, * EXCLUDE (doc_id) FROM left_over), "
    "takes AS (SELECT doc_id, "
    "CASE WHEN miss = 0 OR total = 0 THEN t1 WHEN miss >= total THEN n1 ELSE t1 + len(list_filter(ps, lambda p: p < r1)) END AS k1, "
    "CASE WHEN miss = 0 OR total = 0 THEN t2 WHEN miss >= total THEN n2 ELSE t2 + len(list_filter(ps, lambda p: p >= r1 AND p < r1 + r2)) END AS k2, "
    "CASE WHEN miss = 0 OR total = 0 THEN t3 WHEN miss >= total THEN n3 ELSE t3 + len(list_filter(ps, lambda p: p >= r1 + r2)) END AS k3 FROM picks), "
    f"pool1 AS (SELECT doc_id, 1 AS pool, p AS prompt FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY {hash_of('7', 'doc_id', 'i')}, i) AS rn "
    "FROM (SELECT doc_id, unnest(inverse) AS p, generate_subscripts(inverse, 1) - 1 AS i FROM facts)) JOIN takes USING (doc_id) WHERE rn <= k1), "
    + draw("d2", "nidx", "subjects", f"{_NAMES_N}")
    + ", "
    + draw("d3", "lidx", "labels", f"{_LABELS_N}")
    + f", pool2 AS (SELECT d2.doc_id, 2 AS pool, value || '的' || predicates[{hash_mod('7:pick', 'len(predicates)', 'd2.doc_id', 'value')} + 1] AS prompt FROM d2 JOIN takes USING (doc_id) WHERE rn <= k2), "
    f"pool3 AS (SELECT d3.doc_id, 3 AS pool, subjects[{hash_mod('7:pick', 'len(subjects)', 'd3.doc_id', 'value')} + 1] || '的' || value AS prompt FROM d3 JOIN takes USING (doc_id) WHERE rn <= k3), "
    "train_neg AS (SELECT * FROM pool1 UNION ALL SELECT * FROM pool2 UNION ALL SELECT * FROM pool3)"
)
SQL["relation_train_negatives"] = f"WITH {_CORPUS}, {_POOLS} SELECT doc_id, pool::BIGINT AS pool, prompt FROM train_neg"
SQL["relation_positives"] = (
    f"WITH {_CORPUS} SELECT doc_id, prompt, string_agg(start || ':' || \"end\" || ':' || object, '|' ORDER BY i) AS result FROM trip GROUP BY doc_id, prompt"
)
SQL["entity_positives"] = (
    f"WITH {_CORPUS} SELECT doc_id, label AS prompt, string_agg(start || ':' || (start + length(name)) || ':' || name, '|' ORDER BY id) AS result FROM ent GROUP BY doc_id, label"
)


def options_prompt(head: str, options: list[str], *keys: str) -> str:
    shuffled = " ".join([f"(SELECT string_agg(o, ',' ORDER BY {hash_of('7', *keys, 'o')}) FROM (VALUES {', '.join(f'({quote(o)})' for o in options)}) AS v(o))"])
    return f"{head} || '[' || {shuffled} || ']'"


def back_spans(labels: str) -> str:
    """Labels as spans counted backwards from the end of the prompt."""
    at = "(CASE WHEN instr(reverse(prompt), reverse(l)) = 0 THEN -1 ELSE length(prompt) - instr(reverse(prompt), reverse(l)) + 1 - length(l) END - length(prompt) - 1)"
    return f"array_to_string(list_transform({labels}, lambda l: l || ':' || {at} || ':' || ({at} + length(l))), '|')"


_ASPECT = (
    f"asp AS (SELECT doc_id, classes, {options_prompt(chr(39) + 'mood of ' + chr(39) + ' || name', ['rich', 'poor', 'late'], 'doc_id', 'id - 1')} AS prompt FROM ent WHERE classes IS NOT NULL)"
)
SQL["aspect_prompts"] = f"WITH {_CORPUS}, {_ASPECT} SELECT doc_id, prompt, {back_spans('classes')} AS result FROM asp"


def example_rows(negatives: str, ratio: int) -> str:
    keep = (
        f"(CASE WHEN ceil(({_LABELS_N} - len(labels)) / len(labels)::DOUBLE) <= {ratio} THEN {_LABELS_N} ELSE {ratio} * len(labels) END)" if ratio >= 0 else _LABELS_N
    )
    own = "" if "lidx AS" in negatives else f", {index_of('lidx', 'labels')}"
    table = "train_neg" if "train_neg" in negatives else "full_neg"
    aspect = options_prompt("name || '的情感倾向'", ["rich", "poor", "late"], "doc_id", "id - 1")
    return (
        f"WITH {_CORPUS}, {negatives}{own}, {draw('dl', 'lidx', 'labels', keep)}, asp AS (SELECT doc_id, classes, {aspect} AS prompt FROM ent WHERE classes IS NOT NULL), rows_all AS ("
        "SELECT doc_id, 'entity' AS kind, label AS prompt, string_agg(name || ':' || start || ':' || (start + length(name)), '|' ORDER BY id) AS result FROM ent GROUP BY doc_id, label "
        "UNION ALL SELECT doc_id, 'relation', prompt, string_agg(object || ':' || start || ':' || \"end\", '|' ORDER BY i) FROM trip GROUP BY doc_id, prompt "
        f"UNION ALL SELECT doc_id, 'aspect', prompt, {back_spans('classes')} FROM asp "
        "UNION ALL SELECT doc_id, 'entity', value, '' FROM dl "
        f"UNION ALL SELECT doc_id, 'relation', prompt, '' FROM {table}) "
        "SELECT doc_id, kind, md5(n || ' ' || a || ' ' || s) AS content_md5, prompt, result FROM rows_all JOIN c USING (doc_id)"
    )


SQL["extraction_examples"] = example_rows(_POOLS, 5)
SQL["dev_examples"] = example_rows(_FULL, -1)
SQL["relation_resolve"] = (
    "WITH e AS (SELECT conv_id AS doc_id, turn AS id, 1 AS ord, role AS name, 0 AS start, length(text) AS \"end\" FROM conversations "
    "UNION ALL SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN 0 ELSE 2 END, 'other', 7, 9 FROM conversations WHERE turn % 3 = 1), "
    "l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY doc_id, id ORDER BY ord DESC) = 1), "
    "r AS (SELECT conv_id AS doc_id, turn AS from_id, CASE WHEN conv_id % 13 = 5 THEN turn + 1000 ELSE turn - 1 END AS to_id, CASE WHEN conv_id % 11 <> 0 THEN 'answers' END AS type FROM conversations WHERE turn > 0) "
    "SELECT r.doc_id, r.from_id::BIGINT AS from_id, r.to_id::BIGINT AS to_id, type, a.name AS subject, b.name AS object, b.start::BIGINT AS start, b.\"end\"::BIGINT AS \"end\", "
    "CASE WHEN type IS NULL THEN 'relation without a label' WHEN a.name IS NULL OR b.name IS NULL THEN 'relation to an unknown entity' END AS reason "
    "FROM r LEFT JOIN l a ON a.doc_id = r.doc_id AND a.id = r.from_id LEFT JOIN l b ON b.doc_id = r.doc_id AND b.id = r.to_id"
)
SQL["relation_types"] = f"WITH {_CORPUS} SELECT predicate AS relation, count(*) AS n FROM (SELECT DISTINCT doc_id, prompt, predicate FROM trip) GROUP BY predicate"
_CLS = f"cls AS (SELECT doc_id, [lang] AS labels, {options_prompt(quote('language'), ['en', 'fr', 'de', 'es'], 'doc_id')} AS prompt FROM documents)"
SQL["cls_prompts"] = f"WITH {_CLS} SELECT doc_id, prompt, {back_spans('labels')} AS result FROM cls"
SQL["unify_prompts"] = (
    "SELECT doc_id, 'kind of ' || lang || CASE WHEN doc_id % 3 <> 0 THEN '[' || array_to_string(list_sort(list_distinct([source, 'en', lang])), ',') || ']' ELSE '' END AS prompt FROM documents"
)

# --- splits and ids ---------------------------------------------------------------------------------


def split_by(table: str, key: str, order: str, p1: str, p2: str) -> str:
    return (
        f"SELECT {key}, CASE WHEN rn < {p1} THEN 'train' WHEN rn < {p2} THEN 'dev' ELSE 'test' END AS split FROM "
        f"(SELECT {key}, row_number() OVER (ORDER BY {order}) - 1 AS rn, count(*) OVER ()::DOUBLE AS n FROM {table})"
    )


SQL["split_ie"] = split_by("documents", "doc_id", hash_of("1000", "doc_id"), "round_even(n * 0.8::DOUBLE, 0)", "round_even(n * (0.8::DOUBLE + 0.1::DOUBLE), 0)")
SQL["split_tc"] = split_by("documents", "doc_id", hash_of("1000", "doc_id"), "floor(n * 0.75::DOUBLE)", "floor(n * (0.75::DOUBLE + 0.2::DOUBLE))")
SQL["split_in_order"] = split_by("orders", "o_orderkey", "o_orderkey", "floor(n * 0.7::DOUBLE)", "floor(n * (0.7::DOUBLE + 0.2::DOUBLE))")
SQL["split_signed"] = split_by("(SELECT 20000 - o_orderkey AS key FROM orders)", "key", "key", "floor(n * 0.7::DOUBLE)", "floor(n * (0.7::DOUBLE + 0.2::DOUBLE))")
SQL["split_by_name"] = split_by(
    "(SELECT 'Kunde/Käufer/' || c_name || '/' || c_mktsegment AS key FROM customer)", "key", "encode(key)", "round_even(n * 0.6::DOUBLE, 0)", "round_even(n * (0.6::DOUBLE + 0.3::DOUBLE), 0)"
)
SQL["shuffle_rank"] = f"SELECT o_orderkey, row_number() OVER (ORDER BY {hash_of('1000', 'o_orderkey')}) - 1 AS rank FROM orders"
SQL["running_ids"] = (
    f"WITH {SPANS}, e AS (SELECT *, row_number() OVER (ORDER BY doc_id, start, e_no, ord) AS eid, row_number() OVER (PARTITION BY doc_id ORDER BY e_no, ord) - 1 AS raw FROM spans), "
    "l AS (SELECT b.doc_id, row_number() OVER (ORDER BY b.doc_id, b.raw) AS rid, b.eid AS f, a.eid AS t FROM e b JOIN e a ON a.doc_id = b.doc_id AND a.raw = b.raw - 1), "
    "es AS (SELECT doc_id, string_agg(eid || ':' || entity || ':' || start, '|' ORDER BY eid) AS entities FROM e GROUP BY doc_id), "
    "ls AS (SELECT doc_id, string_agg(rid || ':' || f || ':' || t, '|' ORDER BY rid) AS relations FROM l GROUP BY doc_id) "
    "SELECT d.doc_id, row_number() OVER (ORDER BY d.doc_id) AS id, coalesce(entities, '') AS entities, coalesce(relations, '') AS relations "
    "FROM documents d LEFT JOIN es USING (doc_id) LEFT JOIN ls USING (doc_id)"
)

# --- labels -----------------------------------------------------------------------------------------

_VOCABULARY = "[" + ", ".join(quote(x) for x in LABELS) + "]"
_LABELLED = (
    "lab AS (SELECT doc_id, string_split(text, chr(10)) AS parts, text, "
    "list_filter([CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, lang], lambda x: x IS NOT NULL) AS names "
    "FROM labels JOIN documents USING (doc_id))"
)
SQL["label_examples"] = (
    f"WITH {_LABELLED} SELECT doc_id, md5(CASE WHEN len(parts) = 1 THEN text ELSE array_to_string(parts[1:len(parts) - 1], '') END) AS a_md5, "
    f"CASE WHEN len(parts) = 1 THEN 0 ELSE length(parts[len(parts)]) END::BIGINT AS b_len, {len(LABELS)}::BIGINT AS n_choices, "
    f"array_to_string(list_transform(names, lambda x: list_position({_VOCABULARY}, x) - 1), ',') AS labels FROM lab"
)
SQL["label_rejects"] = (
    f"WITH {_LABELLED} SELECT doc_id, 'label not in vocabulary: ' || array_to_string(list_sort(list_filter(names, lambda x: x IN ('de', 'es'))), ',') AS reason "
    "FROM lab WHERE list_has_any(names, ['de', 'es'])"
)
_RAW_ROWS = (
    "raw_rows AS (SELECT text AS a, "
    f"CASE WHEN doc_id % 7 = 0 THEN 1 ELSE {len(LABELS)} END AS n, "
    "CASE WHEN doc_id % 2 = 0 THEN [doc_id % 3, 5] ELSE [1] END AS l "
    "FROM (SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, 'no' FROM documents WHERE doc_id % 5 = 0))"
)
SQL["label_filter_stats"] = (
    f"WITH {_RAW_ROWS} SELECT count(*) FILTER (WHERE n >= 2 AND length(a) >= 3) AS kept, count(*) FILTER (WHERE NOT (n >= 2 AND length(a) >= 3)) AS skipped FROM raw_rows"
)
SQL["multi_hot"] = (
    f"WITH {_RAW_ROWS} SELECT array_to_string(list_transform(range({len(LABELS)}), lambda i: CASE WHEN list_contains(l, i) THEN '1' ELSE '0' END), '') AS vector, "
    "'' AS text_b, count(*) AS n, sum(length(a))::BIGINT AS chars FROM raw_rows WHERE n >= 2 AND length(a) >= 3 GROUP BY 1"
)
SQL["inference_rows"] = f"SELECT doc_id, md5(text) AS a_md5, '' AS text_b, {quote(','.join(LABELS))} AS choices FROM documents"
_LOGITS = (
    f"lg AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 8) AS x, "
    f"list_transform(range({N_DIMS}), lambda i: CASE WHEN (vec_id + i * label) % 3 = 0 THEN 1 ELSE 0 END) AS y FROM embeddings), "
    "cell AS (SELECT vec_id, unnest(x) AS x, unnest(y) AS y, generate_subscripts(x, 1) - 1 AS i FROM lg), "
    "dec AS (SELECT *, 1 / (1 + exp(-x)) AS p, CASE WHEN 1 / (1 + exp(-x)) > 0.5 THEN 1 ELSE 0 END AS h FROM cell)"
)
SQL["label_decode"] = (
    f"WITH {_LOGITS} SELECT vec_id, coalesce(string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (WHERE h = 1), '') AS hits, "
    "round(coalesce(sum(p) FILTER (WHERE h = 1), 0), 6) AS prob_sum FROM dec GROUP BY vec_id"
)
SQL["label_map"] = f"WITH {_LOGITS} SELECT vec_id, " + ", ".join(f"max(CASE WHEN i = {i} THEN h END)::BIGINT AS d{i}" for i in range(N_DIMS)) + " FROM dec GROUP BY vec_id"
SQL["label_annotation_export"] = (
    "SELECT l.doc_id * 10 AS id, l.doc_id AS jid, md5(d.text) AS text_md5, "
    "array_to_string(list_filter([CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL), ',') AS choices, "
    "'choices' AS type FROM labels l JOIN documents d USING (doc_id)"
)

# --- merge and money --------------------------------------------------------------------------------

_SIDES = (
    "l AS (SELECT c_custkey AS jid, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS kind, c_name || '!' AS entity FROM customer), "
    "r AS (SELECT c_custkey AS jid, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS kind, c_nationkey::BIGINT AS nation, "
    "(c_acctbal > 0)::BIGINT AS good, (c_acctbal > 5000)::BIGINT AS big FROM customer)"
)
SQL["merge_results"] = f"WITH {_SIDES} SELECT l.jid, l.kind, l.entity, r.nation, r.good, r.big FROM l JOIN r ON l.jid = r.jid AND l.kind IS NOT DISTINCT FROM r.kind"
SQL["merge_guard"] = (
    f"WITH {_SIDES}, rr AS (SELECT * FROM r WHERE jid % 4 <> 1) SELECT (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM rr) AS right_rows, "
    "count(*) AS merged_rows FROM l JOIN rr ON l.kind IS NOT DISTINCT FROM rr.kind"
)
_UNREADABLE = "o_orderkey % 13 = 0"
_ABSENT = "o_orderkey % 17 = 0"
_ODD = "o_orderkey % 4 = 3"
SQL["money_normalize"] = (
    f"SELECT o_orderkey AS order_id, CASE WHEN NOT ({_UNREADABLE} OR {_ABSENT} OR {_ODD}) THEN floor(o_totalprice)::BIGINT END AS amount FROM orders"
)
SQL["money_columns"] = (
    f"SELECT o_orderkey AS order_id, CASE WHEN {_UNREADABLE} OR {_ABSENT} OR {_ODD} THEN 'nan' ELSE floor(o_totalprice)::BIGINT::VARCHAR END AS amount FROM orders"
)
SQL["money_error_rate"] = (
    f"SELECT 'amount' AS entity, count(*) FILTER (WHERE {_UNREADABLE} OR ({_ODD} AND NOT {_ABSENT})) AS failed, count(*) AS total, "
    f"round(count(*) FILTER (WHERE {_UNREADABLE} OR ({_ODD} AND NOT {_ABSENT})) / count(*)::DOUBLE, 6) AS error_rate FROM orders "
    "UNION ALL SELECT 'age', 0, count(*), 0.0 FROM orders"
)
SQL["money_failures"] = (
    f"SELECT CASE WHEN {_UNREADABLE} THEN '不詳' ELSE '新' || floor(o_totalprice)::BIGINT END AS raw, count(*) AS n FROM orders "
    f"WHERE {_UNREADABLE} OR ({_ODD} AND NOT {_ABSENT}) GROUP BY 1"
)
_D1 = "translate((o_orderkey % 9 + 1)::VARCHAR, '123456789', '一二三四五六七八九')"
_D2 = "translate((o_custkey % 9 + 1)::VARCHAR, '123456789', '一二三四五六七八九')"
SQL["zero_fill"] = (
    f"SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 = 0 THEN {_D1} || '萬零' || {_D2} || '百元' WHEN o_orderkey % 3 = 1 THEN {_D1} || '千零' || {_D2} || '元' "
    f"ELSE {_D1} || '億零' || {_D2} || '千元' END AS filled FROM orders"
)

# --- metrics ----------------------------------------------------------------------------------------

_LOOSER = [(e, {"card": "[0-9]{12,16}", "email": "[A-Za-z0-9.]+@[A-Za-z0-9.]+"}.get(e, p)) for e, p in RULE_PAIRS]
_PAIRS = (
    f"g AS (SELECT DISTINCT doc_id, entity, start, \"end\" FROM ({hits_of(RULE_PAIRS)})), "
    f"p AS (SELECT DISTINCT doc_id, entity, start, \"end\" FROM ({hits_of(_LOOSER)}) WHERE {STAND_IN} > 0.1), "
    "j AS (SELECT coalesce(g.entity, p.entity) AS entity, (g.doc_id IS NOT NULL)::BIGINT AS gold, (p.doc_id IS NOT NULL)::BIGINT AS pred, "
    "(g.doc_id IS NOT NULL AND p.doc_id IS NOT NULL)::BIGINT AS ok FROM g FULL JOIN p ON g.doc_id = p.doc_id AND g.entity = p.entity AND g.start = p.start AND g.\"end\" = p.\"end\")"
)
_SUMS = "coalesce(sum(ok), 0)::BIGINT AS correct, coalesce(sum(pred), 0)::BIGINT AS predicted, coalesce(sum(gold), 0)::BIGINT AS gold"
_SCORES = (
    "*, CASE WHEN predicted = 0 THEN 0 ELSE round(correct / predicted::DOUBLE, 6) END AS precision, CASE WHEN gold = 0 THEN 0 ELSE round(correct / gold::DOUBLE, 6) END AS recall, "
    "CASE WHEN predicted + gold = 0 THEN 0 ELSE round(2 * correct / (predicted + gold)::DOUBLE, 6) END AS f1"
)
SQL["span_prf_total"] = f"WITH {_PAIRS} SELECT {_SCORES} FROM (SELECT {_SUMS} FROM j)"
SQL["span_prf_by_class"] = (
    f"WITH {_PAIRS}, a AS (SELECT n.entity, ok, pred, gold FROM {NAMES} LEFT JOIN j ON j.entity = n.entity) "
    f"SELECT {_SCORES} FROM (SELECT CASE WHEN grouping(entity) = 1 THEN 'total' ELSE entity END AS entity, {_SUMS} FROM a GROUP BY GROUPING SETS ((entity), ()))"
)
SQL["span_prf_long"] = (
    f"WITH {_PAIRS} SELECT {_SCORES} FROM (SELECT CASE WHEN grouping(entity) = 1 THEN 'total' ELSE entity END AS entity, {_SUMS} FROM j GROUP BY GROUPING SETS ((entity), ()))"
)
SQL["entity_prefix_check"] = (
    "WITH n AS (SELECT DISTINCT p_type AS x FROM part UNION SELECT n_name FROM nation), m AS (SELECT min(length(x)) AS k FROM n) "
    "SELECT k::BIGINT AS prefix_len, count(*) AS names, count(DISTINCT left(x, k)) AS prefixes, count(*) = count(DISTINCT left(x, k)) AS distinguishable FROM n, m GROUP BY k"
)
_COUNTS = (
    f"{_LOGITS}, per AS (SELECT i, sum((y = 1 AND h = 1)::INT) AS tp, sum((y = 0 AND h = 1)::INT) AS fp, sum((y = 1 AND h = 0)::INT) AS fn FROM dec GROUP BY i), "
    "rat AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS r, "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f, tp + fn AS s FROM per)"
)
SQL["multilabel_metrics"] = (
    f"WITH {_COUNTS} SELECT round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn))::DOUBLE, 6) AS micro_f1, round(avg(f), 6) AS macro_f1, "
    "(SELECT round(avg(ok), 6) FROM (SELECT min((y = h)::INT) AS ok FROM dec GROUP BY vec_id)) AS accuracy, "
    "round(sum(tp) / (sum(tp) + sum(fp))::DOUBLE, 6) AS precision, round(sum(tp) / (sum(tp) + sum(fn))::DOUBLE, 6) AS recall FROM rat"
)
SQL["label_report"] = (
    f"WITH {_COUNTS} SELECT 'd' || i AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s::BIGINT AS support FROM rat "
    "UNION ALL SELECT 'micro avg', round(sum(tp) / (sum(tp) + sum(fp))::DOUBLE, 6), round(sum(tp) / sum(s)::DOUBLE, 6), round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn))::DOUBLE, 6), sum(s)::BIGINT FROM rat "
    "UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(s)::BIGINT FROM rat "
    "UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), sum(s)::BIGINT FROM rat"
)
SQL["ranking_loss"] = (
    f"WITH {_LOGITS}, m AS (SELECT vec_id, x, CASE WHEN (vec_id + i) % 11 = 0 THEN -100 ELSE y END AS y FROM cell) "
    "SELECT round(avg(l), 6) AS ranking_loss FROM (SELECT vec_id, ln(1 + coalesce(sum(exp(x)) FILTER (WHERE y = 0), 0)) + ln(1 + coalesce(sum(exp(-x)) FILTER (WHERE y = 1), 0)) AS l FROM m GROUP BY vec_id)"
)
SQL["span_bce"] = (
    f"WITH {_LOGITS}, q AS (SELECT a.y, a.p AS p, b.p AS e FROM dec a JOIN dec b ON a.vec_id = b.vec_id AND b.i = {N_DIMS} - 1 - a.i) "
    "SELECT round((avg(-(y * ln(p) + (1 - y) * ln(1 - p))) + avg(-(y * ln(e) + (1 - y) * ln(1 - e)))) / 2, 6) AS span_loss FROM q"
)
SQL["validate_examples"] = (
    f"WITH {SPANS}, e AS (SELECT d.doc_id, n.entity, s.n FROM documents d CROSS JOIN {NAMES} LEFT JOIN (SELECT doc_id, entity, count(*) AS n FROM spans GROUP BY ALL) s "
    "ON s.doc_id = d.doc_id AND s.entity = n.entity), "
    "w AS (SELECT CASE WHEN doc_id % 10 = 3 THEN 'missing key' WHEN doc_id % 9 = 0 THEN 'unknown prompt' WHEN doc_id % 4 = 1 AND n > 0 THEN 'slice differs from span text' END AS reason FROM e) "
    "SELECT reason, count(*) AS n FROM w WHERE reason IS NOT NULL GROUP BY reason"
)

SQL["fit_labels"] = (
    "WITH n AS (SELECT count(*) AS n FROM labels JOIN documents USING (doc_id)) "
    "SELECT floor(n * 0.7::DOUBLE)::BIGINT AS n_train, (floor(n * (0.7::DOUBLE + 0.3::DOUBLE)) - floor(n * 0.7::DOUBLE))::BIGINT AS n_dev, 'quality,en,fr' AS vocabulary, TRUE AS beats_majority FROM n"
)

# --- files ------------------------------------------------------------------------------------------

_OWN_LABELLED = (
    "lab AS (SELECT doc_id, string_split(text, chr(10)) AS parts, text, "
    "list_filter([CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, lang], lambda x: x IS NOT NULL) AS names "
    "FROM labels JOIN documents USING (doc_id)), "
    "sp AS (SELECT doc_id, CASE WHEN rn < floor(n * 0.7::DOUBLE) THEN 'train' WHEN rn < floor(n * (0.7::DOUBLE + 0.2::DOUBLE)) THEN 'dev' ELSE 'test' END AS split "
    f"FROM (SELECT doc_id, row_number() OVER (ORDER BY {hash_of('11', 'doc_id')}) - 1 AS rn, count(*) OVER () AS n FROM lab))"
)
SQL["files_label_job"] = (
    f"WITH {_OWN_LABELLED} SELECT split, md5(CASE WHEN len(parts) = 1 THEN text ELSE array_to_string(parts[1:len(parts) - 1], '') END) AS a_md5, "
    "md5(CASE WHEN len(parts) = 1 THEN '' ELSE parts[len(parts)] END) AS b_md5, '' AS question, "
    f"{quote(','.join(LABELS))} AS choices, array_to_string(list_transform(names, lambda x: list_position({_VOCABULARY}, x) - 1), ',') AS labels FROM lab JOIN sp USING (doc_id)"
)
SQL["files_label_job_one_split"] = (
    f"WITH {_OWN_LABELLED} SELECT split, count(*) AS n, sum(length(replace(text, chr(10), '')))::BIGINT AS chars FROM lab, (VALUES ('train'), ('dev'), ('test')) AS v(split) GROUP BY split"
)
SQL["files_choice_job"] = (
    f"WITH {_CLS}, sp AS (SELECT doc_id, CASE WHEN rn < floor(n * 0.5::DOUBLE) THEN 'train' WHEN rn < floor(n * (0.5::DOUBLE + 0.3::DOUBLE)) THEN 'dev' ELSE 'test' END AS split "
    f"FROM (SELECT doc_id, row_number() OVER (ORDER BY {hash_of('7', 'doc_id')}) - 1 AS rn, count(*) OVER () AS n FROM documents)) "
    f"SELECT split, md5(d.text) AS content_md5, prompt, {back_spans('labels')} AS result FROM cls JOIN sp USING (doc_id) JOIN documents d USING (doc_id)"
)
# Documents are numbered anew by the job.
SQL["files_extraction_job"] = (
    example_rows(_POOLS, 5)
    .replace("SELECT doc_id, kind, md5(", "SELECT 'train' AS split, kind, md5(")
    .replace("SELECT c_custkey AS doc_id, c_name AS n,", "SELECT row_number() OVER (ORDER BY c_custkey) AS doc_id, c_name AS n,")
)
SQL["files_annotations"] = moved() + (
    "SELECT d.doc_id, md5(d.short) AS text_md5, count(f.entity) AS n_spans, "
    "coalesce(string_agg(f.entity || ':' || f.start || ':' || f.\"end\" || ':' || f.text, '|' ORDER BY f.raw_start, f.e_no, f.ord), '') AS spans "
    "FROM d LEFT JOIN (SELECT f.*, h.start AS raw_start FROM f JOIN hits h USING (doc_id, e_no, ord)) f USING (doc_id) GROUP BY d.doc_id, d.short"
)
SQL["files_verdicts"] = "SELECT doc_id::VARCHAR AS jid, lang AS jtitle, md5(text) AS text_md5, length(text)::BIGINT AS n_chars FROM documents"
SQL["files_text_lines"] = f"SELECT md5(trim(translate(text, chr(10) || chr(13), '  '), {BLANKS})) AS line_md5, count(*) AS n FROM documents GROUP BY 1"
SQL["files_prompt_splits"] = (
    f"WITH {SPANS}, g AS (SELECT doc_id, entity, string_agg(start || ':' || \"end\" || ':' || text, '|' ORDER BY start) AS result FROM spans GROUP BY doc_id, entity), "
    + "sp AS ("
    + split_by("documents", "doc_id", hash_of("1000", "doc_id"), "round_even(n * 0.8::DOUBLE, 0)", "round_even(n * (0.8::DOUBLE + 0.1::DOUBLE), 0)")
    + f") SELECT sp.split, n.entity AS prompt, md5(d.text) AS content_md5, coalesce(g.result, '') AS result, NULL::VARCHAR AS reason "
    f"FROM documents d JOIN sp USING (doc_id) CROSS JOIN {NAMES} LEFT JOIN g ON g.doc_id = d.doc_id AND g.entity = n.entity"
)
SQL["files_flat_table"] = (
    f"WITH {SPANS}, best AS ({ranked()}) SELECT d.doc_id, {_FLAT} FROM documents d LEFT JOIN best b USING (doc_id) GROUP BY d.doc_id"
)
SQL["files_merge_job"] = SQL["merge_results"]
SQL["files_corpus_layouts"] = (
    f"WITH {_CORPUS} SELECT c.doc_id, md5(n || ' ' || a || ' ' || s) AS text_md5, "
    "(SELECT string_agg((CASE WHEN c.doc_id % 4 = 0 THEN e.id - 1 ELSE e.id END) || ':' || (CASE WHEN classes IS NULL THEN label ELSE label || '##' || array_to_string(classes, '##') END) "
    "|| ':' || e.start || ':' || (e.start + length(e.name)), '|' ORDER BY e.id) FROM ent e WHERE e.doc_id = c.doc_id) AS entities, "
    "CASE WHEN c.doc_id % 4 = 0 THEN '' ELSE coalesce((SELECT string_agg(r.i || ':' || r.f || ':' || r.t || ':' || r.p, '|' ORDER BY r.i) FROM rel r WHERE r.doc_id = c.doc_id), '') END AS relations FROM c"
)
SQL["files_span_evaluation"] = SQL["span_prf_by_class"]
SQL["files_label_predictions"] = (
    f"WITH {_LOGITS} SELECT vec_id AS id, coalesce(string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (WHERE h = 1), '') AS labels, "
    "round(coalesce(sum(p) FILTER (WHERE h = 1), 0), 6) AS prob_sum FROM dec GROUP BY vec_id"
)
SQL["files_label_metrics"] = SQL["multilabel_metrics"]
SQL["files_shortened"] = shrunk() + (
    ", sp AS ("
    + split_by("documents", "doc_id", hash_of("1000", "doc_id"), "round_even(n * 0.8::DOUBLE, 0)", "round_even(n * (0.8::DOUBLE + 0.1::DOUBLE), 0)")
    + ") SELECT short.doc_id, split, length(text)::BIGINT AS short_len, md5(text) AS short_md5 FROM short JOIN sp USING (doc_id)"
)

ORACLE: dict[str, str] = SQL
