"""Line dedup, whitening and hard negatives on awkward rows and against plain loops."""

from __future__ import annotations

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import hard_negatives, line_dedup, vectors, whitening

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- lines ---------------------------------------------------------------------------------------


def lines_by_loop(rows, least, documents):
    holders = collections.defaultdict(set)
    key = lambda line: line.strip(WHITE).translate(LOWER)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-math.inf if i is None else i)
    out = collections.Counter()
    for i, text in rows:
        lines = (text or "").split("\n")
        own = -math.inf if i is None else i
        gone = [len(key(x)) >= least and len(holders[key(x)]) >= documents and max(holders[key(x)]) != own for x in lines]
        out[i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)] += 1
    return out


def text_rows():
    draw = np.random.default_rng(5)
    pool = [f"Line {n} of some É words" for n in range(12)] + ["short", "", " \t", "Äußerst lange Zeile mit ÄÖÜ am Ende"]
    rows = [(int(i), "\n".join(("  " if draw.integers(3) == 0 else "") + (pool[j].upper() if draw.integers(2) else pool[j]) + ("\r" if draw.integers(4) == 0 else "") for j in draw.integers(0, len(pool), draw.integers(0, 9)))) for i in range(60)]
    hot = [(100 + i, "the very same line in a third of all rows\nown line number %d here" % i) for i in range(40)]
    odd = [(None, None), (None, "the very same line in a third of all rows"), (None, "another without an id\nthe very same line in a third of all rows"), (7, ""), (7, ""), (8, "\n\n"),
           (200, "\n".join(f"line {n % 11} of some é words" for n in range(3000))), (3, "the very same line in a third of all rows\n" * 3)]
    return rows + hot + odd


SCHEMA = "doc_id bigint, text string, h1 string, code string, places string, batch string"


@pytest.mark.parametrize(("batches", "fan_out", "hot"), [(1, 2, 1_000), (4, 2, 1_000), (5, 3, 3)])
def test_lines(spark, monkeypatch, batches, fan_out, hot):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", hot)
    rows = text_rows()
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)
    got = line_dedup.deduplicated_lines(docs, least_chars=20, documents=5, batches=batches, fan_out=fan_out)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert collections.Counter(map(tuple, got.collect())) == lines_by_loop(rows, 20, 5)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_no_lines(spark):
    assert line_dedup.deduplicated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_leave_out_what_is_settled_and_compact(spark):
    def batch(ids, keys):
        return spark.createDataFrame([(i, k, -k) for i in ids for k in keys], "doc_id bigint, h1 bigint, h2 bigint")

    with line_dedup.LineRuns(spark, documents=3, fan_out=3) as runs:
        runs.add(batch([9, 8, 7], [1, 2]))
        runs.add(batch([6, 5], [1, 2, 3]))  # 1 and 2 are settled
        assert [len(level) for level in runs.levels] == [2]
        assert spark.table(runs.levels[0][1]).collect()[0]["h1"] == 3
        runs.add(batch([11], [1, 3]))  # out of order: the keeper of 1 changes
        assert [len(level) for level in runs.levels] == [0, 1]
        assert spark.table(runs.levels[1][0]).count() == 3
        found = {r["h1"]: (r["documents"] >= 3, r["keeper"]) for r in runs.frequent().collect()}
    assert found == {1: (True, 11), 2: (True, 9), 3: (True, 11)}


def test_merge_moves_no_run(spark):
    # Runs of buckets are joined where they lie: only the new batch is exchanged.
    with line_dedup.LineRuns(spark, documents=2, fan_out=9, buckets=4) as runs:
        runs.add(spark.range(500).selectExpr("id AS doc_id", "id % 7 AS h1", "id AS h2"))
        run = spark.table(runs.levels[0][0])
        batch = spark.range(500).selectExpr("id % 7 AS h1", "id AS h2").hint("merge")
        plan = batch.join(run, ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


# --- vectors -------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, x string, weight string, n string, anchor string, score string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash", "clash") for r in rows], VECTORS).repartition(4)


def odd_vectors(draw, n, d):
    rows = [(int(i), draw.normal(size=d).round(3).tolist(), int(draw.integers(0, 4))) for i in range(n)]
    rows += [(1000 + i, rows[5][1], i % 4) for i in range(n // 2)]  # one vector of a third of all rows
    return rows + [(2000, None, 1), (2001, [None] * d, 1), (2002, [float("nan")] * d, 1), (2003, [float("inf")] * d, 1), (None, rows[6][1], 1), (2004, rows[7][1], None), (2005, [1.0], 2), (2006, [], 2), (3, rows[3][1], rows[3][2])]


def test_whole_vectors(spark):
    frame = vector_frame(spark, [(1, [0.5, -0.2501], 1), (2, [1e30, -1e30], 1), (3, [None, 1.0], 1), (4, None, 1), (5, [], 1)])
    got = {r["i"]: r["x"] for r in vectors.whole_vectors(frame, F.col("embedding"), {"i": F.col("vec_id")}, 4, 10, bound=1000).collect()}
    assert got == {1: [12, 8], 2: [1000, -1000], 5: []}


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening(spark, monkeypatch, weights):
    monkeypatch.setattr(whitening, "HOT_ROWS", 10)
    d, rows = 6, odd_vectors(np.random.default_rng(1), 60, 6)
    got = whitening.whitened(vector_frame(spark, rows), components=4, weights=weights).collect()
    good = [(i, v) for i, v, _ in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good])
    fit = x if weights == "counts" else np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    values, basis = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, basis = values[::-1], basis[:, ::-1]
    assert {r["n"] for r in got} == {n} and collections.Counter(r["component"] for r in got) == {c: len(good) for c in (1, 2, 3, 4)}
    deviation = ((n * x - total) ** 2).sum(axis=1)
    white = (x - total / n) @ (basis / np.sqrt(values))
    expected = {c: collections.Counter((i, int(deviation[r]), round(abs(white[r, c - 1]), 6)) for r, (i, _) in enumerate(good)) for c in (1, 2, 3, 4)}
    for c in expected:
        mine = [r for r in got if r["component"] == c]
        assert collections.Counter((r["vec_id"], r["deviation"], round(abs(r["whitened"]), 6)) for r in mine) == expected[c]
        assert all(math.isclose(r["explained"], values[c - 1] / values.sum(), rel_tol=1e-9) for r in mine)
    assert {r["identity_error"] < 1e-9 for r in got} == {True}


def test_whitening_without_variance(spark):
    assert whitening.whitened(vector_frame(spark, [])).count() == 0
    assert whitening.whitened(vector_frame(spark, [(1, None, 1), (2, [], 1)])).count() == 0
    assert whitening.whitened(vector_frame(spark, [(1, [0.5, 0.25], 1)] * 3)).count() == 0
    flat = whitening.whitened(vector_frame(spark, [(i, [float(i), 1.0, 2.0 * i], 1) for i in range(9)]))
    assert {r["component"] for r in flat.collect()} == {1}


def test_deviations_beyond_64_bits(spark):
    x, total = np.array([[1 << 50, -5]]), [(1 << 50) * 9, 7]
    assert whitening.deviations(x, 10_000, total).tolist() == [[10_000 * (1 << 50) - total[0], -50_007]]
    rows = whitening.whitened(vector_frame(spark, [(i, [1e15 * i, 1.0 * i * i], 1) for i in range(4)])).collect()
    # Beside a variance of 10^36 the other direction has none.
    assert len(rows) == 4 and {r["deviation"] for r in rows} == {None}


def negatives_by_loop(rows, label, anchors, positives, negatives, low, high):
    best = {}
    for i, v, _ in rows:
        own = label(i, _) if i is not None and _ is not None else None
        if own is None or v is None or not all(c is not None and math.isfinite(c) for c in v):
            continue
        p = (own, [math.floor(256 * float(np.float32(c))) for c in v])
        best[i] = min(best.get(i, p), p)
    out = []
    for a, (mine, x) in best.items():
        if not anchors(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), i, other == mine) for i, (other, y) in best.items() if i != a)
        for s, p, _ in [t for t in scored if t[2]][:positives]:
            inside = [t for t in scored if not t[2] and low * -s <= 100 * -t[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("cell", [(16_384, 1_024), (20, 3)])
def test_hard_negatives(spark, monkeypatch, cell):
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", cell[0])
    monkeypatch.setattr(hard_negatives, "CELL_ANCHORS", cell[1])
    monkeypatch.setattr(hard_negatives, "CELL_SCORES", 64)
    rows = odd_vectors(np.random.default_rng(2), 80, 5) + [(3000 + i, [0.0] * 5, i % 3) for i in range(30)] + [(4000, [3e38, -3e38, 0.0, 0.0, 0.0], 1)]
    rows = [(i, [c / 2 for c in v] if i == 3 and v else v, x) for i, v, x in rows]  # an id with two different rows
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    frame = vector_frame(spark, rows)
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 3 == 0, label, positives=5, negatives=10)
    small = [(i, None if v is None else [None if c is None else c if not math.isfinite(c) else max(-(1 << 19), min(c, 1 << 19)) for c in v], x) for i, v, x in rows]
    expected = negatives_by_loop(small, lambda i, x: (x + 1) % 4 if i % 7 == 0 else x, lambda i: i % 3 == 0, 5, 10, 30, 90)
    assert sorted(map(tuple, got.collect())) == expected and any(r[4] == 0 for r in expected) and any(r[2] == 10 for r in expected)


def test_no_hard_negatives(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0], 1), (2, [1.0], 1)]):
        assert hard_negatives.hard_negatives(vector_frame(spark, rows), F.col("vec_id") > 0, F.col("label")).count() == 0
    assert hard_negatives.hard_negatives(vector_frame(spark, [(1, [1.0], 1)]), F.lit(None).cast("boolean"), F.col("label")).count() == 0
    with pytest.raises(ValueError, match="per cent"):
        hard_negatives.hard_negatives(vector_frame(spark, []), F.lit(True), F.col("label"), low=90, high=90)


# --- scores --------------------------------------------------------------------------------------


def test_scores_without_rare_words(spark):
    """A slice in which every word is frequent."""
    from spanloom.llm import lm_score

    docs = spark.createDataFrame([(1, "a b a"), (2, "a b")], "doc_id bigint, text string")
    rows = lm_score.scores(docs, held_out=F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"]) for r in rows} == {(1, 4, 4), (2, 3, 3)}
