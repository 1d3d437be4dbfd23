"""SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE = {
    "op2_exact_dedup": """
        WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
        FROM d JOIN g USING (body)
    """,
    "op11_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM l),
        f AS (SELECT body, max(doc_id) AS keeper FROM k WHERE length(body) >= 40 GROUP BY body HAVING count(DISTINCT doc_id) >= 5),
        m AS (SELECT k.doc_id, k.place, k.line, f.body IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON k.body = f.body)
        SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op13_hard_negatives": """
        WITH r AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
        p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
              FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        f AS (SELECT anchor_id, id, score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT f.anchor_id, f.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, p.id AS negative_id, f.score AS positive_score, p.score AS negative_score
        FROM f JOIN p ON p.anchor_id = f.anchor_id AND NOT p.same AND 30 * f.score <= 100 * p.score AND 100 * p.score <= 90 * f.score
        WINDOW w AS (PARTITION BY f.anchor_id, f.id ORDER BY p.score DESC, p.id)
        QUALIFY row_number() OVER w <= 10
    """,
}
