"""Each numbered operator on awkward rows and against plain loops."""

from __future__ import annotations

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import common, decontaminate, exact_dedup, jaccard_join, lm_score, packing, quality, sharding, substring_dedup, token_files, warc
from spanloom.llm.queries import id_remainder, vocabulary

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, code string, n string"
LONG = " ".join(f"w{i * i % 997}" for i in range(9000))
#: NULLs, empty and blank texts, a very long text, repeated rows, texts in two cases, and odd white space.
AWKWARD = [
    (1, "a b c d e f g h i j k l m n o p"), (2, "A b c d e f g h i j k l m n o p"), (3, None), (4, ""), (5, " \n\t "), (6, LONG),
    (7, LONG + " tail"), (8, "one two"), (9, "One  two"), (9, "One  two"), (None, "no id at all"), (None, None), (10, "x"),
    (11, "héllo wörld é ́ \xa0 “quoted” <|endoftext|>  z"), (12, "a b c d e f g h i j k l m q o p"), (13, LONG),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Further columns bear names that the operators use themselves.
    return spark.createDataFrame([(i, t, "en", "clash", "n") for i, t in AWKWARD], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text, lower=False):
    data = (text or "").encode()
    return WORD.findall(data.lower() if lower else data)


def encoded(name, text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packing(docs, none):
    rows = packing.packed_documents(docs, vocabulary("word_bpe_49k.json"), 2, 64).collect()
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    expected = collections.Counter()
    for i, t in AWKWARD:
        ids = np.array([*encoded("word_bpe_49k.json", t), 2], "<u4")
        for a in range(0, len(ids), 64):
            expected[i, a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes()), len(ids)] += 1
    assert expected == collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.packed_documents(none, vocabulary("word_bpe_49k.json"), 2).count() == 0


def test_packing_is_best_fit():
    draw = np.random.default_rng(3)
    lengths = np.sort(draw.integers(1, 101, 400))[::-1]
    window, offset = packing.best_fit_decreasing(lengths, 100)
    left: list[int] = []
    for n, w, o in zip(lengths, window, offset, strict=True):
        fits = [x for x in left if x >= n]
        if fits:
            assert 100 - o == min(fits)
            left.remove(min(fits))
        else:
            assert o == 0
        left.append(100 - o - n)
    assert len(set(window.tolist())) == len(left)


def test_packed_sequences_hold_their_ids(docs):
    pieces = packing.token_pieces(docs.filter("doc_id < 9"), vocabulary("word_bpe_49k.json"), 2, 64, with_ids=True)
    rows = packing.packed_sequences(packing.pack(pieces, 64)).collect()
    total = sum(len(encoded("word_bpe_49k.json", t)) + 1 for i, t in AWKWARD if i is not None and i < 9)
    assert sum(len(r["ids"]) for r in rows) == total
    assert all(len(r["ids"]) <= 64 and r["doc_starts"][0] == 0 for r in rows)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(docs, none, keep, monkeypatch):
    for hot in (256, 1):  # with 1 every repeated text is dealt over several parts
        monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot)
        rows = exact_dedup.exact_groups(docs, keep=keep).collect()
        groups = collections.defaultdict(list)
        for i, t in AWKWARD:
            groups[t or ""].append(i)
        expected = collections.Counter()
        for t, ids in groups.items():
            order = sorted(ids, key=lambda i: -1 if i is None else i)
            stays = order[0] if keep == "smallest" else order[-1]
            for i in ids:
                expected[i, stays, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
        assert expected == collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows)
        kept = collections.Counter(r["text_sha256"] for r in rows if r["kept"])
        assert set(kept.values()) == {1} and len(kept) == len(groups)
        assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
        distinct = exact_dedup.exact_distinct(docs, keep=keep)
        assert distinct.columns == docs.columns and {r["code"] for r in distinct.collect()} == {"clash"}
        assert collections.Counter(r["text"] or "" for r in distinct.collect()) == {t: 1 for t in groups}
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.exact_distinct(none).count() == 0


def test_exact_groups_by_a_normal_form(docs):
    rows = exact_dedup.exact_groups(docs, normalise=F.lower).filter("doc_id IN (1, 2)").collect()
    assert {(r["keep_id"], r["group_size"]) for r in rows} == {(1, 2)}


def test_hot_text_is_one_group(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_dedup.exact_groups(frame).filter("group_size > 1")
    assert [tuple(r) for r in rows.groupBy("keep_id", "group_size").agg(F.count("*"), F.sum(F.col("kept").cast("int"))).collect()] == [(0, 1000, 1000, 1)]


def test_lm_scores(docs, none):
    rows = lm_score.scores(docs, held_out=id_remainder(7) == 2).collect()
    counts, held = collections.Counter(), lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for i, t in AWKWARD:
        if not held(i):
            counts.update([*words(t, True), None])
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for i, t in AWKWARD:
        tokens = [*words(t, True), None]
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        expected.append((i is None, i or 0, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 6)))
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm_score.scores(none, held_out=F.lit(False)).count() == 0
    nothing_learnt = lm_score.scores(docs, held_out=F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) for r in nothing_learnt)


def test_lm_probabilities_add_up_to_one():
    share = np.full(lm_score.UNITS, 1 / lm_score.UNITS)
    model = lm_score.LogBilinear(share)
    context = np.random.default_rng(1).integers(0, lm_score.UNITS + 1, (3, lm_score.CONTEXT))
    for row in context:
        logs = model.log_probabilities(np.repeat(row[None], lm_score.UNITS, 0), np.arange(lm_score.UNITS))
        assert abs(np.exp(logs).sum() - 1) < 1e-5


def test_noise_contrast_learns_a_pattern():
    unit = np.tile([3, 7, 9], 3000)
    context = lm_score.contexts_of(unit, np.zeros(len(unit), int))
    share = (np.bincount(unit, minlength=lm_score.UNITS) + 1.0) / (len(unit) + lm_score.UNITS)
    model = lm_score.LogBilinear(share)
    contrast = lm_score.NoiseContrast(model, share)
    before = model.log_probabilities(context, unit).mean()
    for _ in range(60):
        contrast.step(context, unit)
    assert model.log_probabilities(context, unit).mean() > before + 0.7


def components_of(rows, size, share):
    sets = []
    for i, t in rows:
        w = words(t, True)
        sets.append((i, {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= share * len(x | y):
                parent[root(a)] = root(b)
    members = collections.defaultdict(list)
    for k in range(len(sets)):
        members[root(k)].append(sets[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return collections.Counter((i, len(s), least[root(k)] if s else i) for k, (i, s) in enumerate(sets))


def drifting(seed=5, n=160):
    """Families of texts that drift away from each other, some lines that many share, and unlike texts."""
    draw, rows = np.random.default_rng(seed), []
    shared = [f"s{k}" for k in range(30)]
    while len(rows) < n:
        text = [f"v{k}" for k in draw.integers(0, 4000, draw.integers(8, 120))]
        if draw.random() < 0.4:
            text = shared + text
        for _ in range(draw.integers(1, 7)):
            rows.append((len(rows), " ".join(text)))
            for _ in range(draw.integers(0, 4)):
                text[draw.integers(0, len(text))] = f"v{draw.integers(0, 4000)}"
    return rows


@pytest.mark.parametrize(("size", "share"), [(4, 85), (5, 80), (2, 50)])
def test_similar_groups(spark, size, share, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TREE_MEMBERS", 8)  # larger blocks are cut
    rows = drifting()
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), size, share).collect()
    assert collections.Counter(map(tuple, got)) == components_of(rows, size, share)


def test_similar_groups_awkward(docs, none):
    got = jaccard_join.similar_groups(docs, 4, 85).collect()
    assert collections.Counter(map(tuple, got)) == components_of(AWKWARD, 4, 85)
    stay = jaccard_join.without_similar(docs, 4, 85)
    assert stay.columns == docs.columns
    ids = {r["doc_id"] for r in stay.collect()}
    assert 1 in ids and 2 not in ids and 6 in ids and 7 not in ids and {3, 4, 5, 10} <= ids
    assert jaccard_join.similar_groups(none).count() == 0 and jaccard_join.without_similar(none).count() == 0


def test_tree_finds_what_a_scan_finds():
    draw = np.random.default_rng(2)
    points, sizes = draw.poisson(3, (300, 16)), None
    points[::3] = points[0] + draw.integers(0, 2, (100, 16))
    sizes = points.sum(1)
    tree = jaccard_join.CountTree(points, sizes)
    for i in range(0, 300, 7):
        bound = np.minimum(points, points[i]).sum(1)
        scan = set(np.flatnonzero(185 * bound >= 85 * (sizes + sizes[i])))
        assert {int(k) for k in tree.near(points[i], int(sizes[i]), 85)} >= scan


QUESTION = "In the morning, Thomas walked 12 km to the market and bought 3 kg of apples for 7 dollars before noon"
LEAKS = [
    (1, f"Before. {QUESTION} and went on."), (2, QUESTION.replace("Thomas", "Maria").replace("12", "45").replace("3 kg", "9 kg").upper().replace("MARIA", "Maria")),
    (3, QUESTION.replace("Thomas", "Maria").replace("12 km", "45 km")), (4, "In the morning it was cold and nobody walked to the market"), (5, None), (6, ""),
    (7, QUESTION[:30]), (None, QUESTION), (8, LONG + " " + QUESTION), (9, "short one"),
]


def test_leaks(spark, none):
    frame = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in LEAKS], "doc_id bigint, text string, item_id string, code string, words string")
    items = spark.createDataFrame([(10, QUESTION), (11, QUESTION), (12, None), (13, "too short"), (14, "")], "item_id bigint, text string")
    got = {(r["doc_id"]): (r["contaminated"], r["item_id"], r["verbatim"]) for r in decontaminate.leaks(frame, items).collect()}
    assert {k for k, v in got.items() if v[0]} == {1, 3, 8, None} | ({2} if got[2][0] else set())
    assert got[1] == (True, 10, True) and got[3] == (True, 10, False) and got[8][1:] == (10, True) and got[4] == (False, None, False)
    clean = decontaminate.without_leaks(frame, items)
    assert clean.columns == frame.columns and {4, 5, 6, 7, 9} <= {r["doc_id"] for r in clean.collect()} <= {2, 4, 5, 6, 7, 9}
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(frame, items.limit(0)).filter("contaminated").count() == 0


def test_slots_must_be_consistent(spark):
    item = "after lunch Alice gave Alice seven red balls and Alice then gave back five of them to the child"
    items = spark.createDataFrame([(1, "we saw that Alice gave 5 coins and Alice took 5 coins from the box on the table there")], "item_id bigint, text string")
    texts = [(1, "we saw that Bruno gave 8 coins and Bruno took 8 coins from the box on the table there"), (2, "we saw that Bruno gave 8 coins and Carla took 9 coins from the box on the table there"), (3, item)]
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.leaks(spark.createDataFrame(texts, "doc_id bigint, text string"), items).collect()}
    assert got == {1: True, 2: False, 3: False}


def leaked(spark, item, *texts):
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: (r["contaminated"], r["matched_words"], r["verbatim"]) for r in decontaminate.leaks(frame, items).collect()}


def test_a_clash_of_slots_leaves_the_words_around_it(spark):
    item = "the farmer left the yard at 5 in the morning with his two dogs and came back to the old house by the lake after 5 hours of work in there"
    other = "the clerk wrote that 5 coins and then 7 coins lay in the drawer under the old desk by the door"
    got = leaked(spark, item, item.replace("after 5", "after 6"), item.replace("at 5", "at 8").replace("after 5", "after 6"), "as we know " + item)
    assert got == {0: (True, 25, True), 1: (True, 24, False), 2: (True, 31, True)}
    got = leaked(spark, other, other.replace("5", "6").replace("7", "6"), other.replace("5", "6"), "1 2 3 4 5 6 7 8 9 10 11 12 13 14")
    assert got == {0: (True, 21, False), 1: (True, 21, False), 2: (False, 0, False)}
    # Slots alone: two values that become one are a chance.
    assert leaked(spark, "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "21 21 23 24 25 21 27 28 29 21 31 32 33 34") == {0: (False, 0, False)}


def test_copies_in_other_case_and_punctuation(spark):
    item = "We know that Alice and Boris, with Clara, met near Dover. Then Emil, who knew Frank, told Greta: the boat to Hull is late"
    changed = item.replace("Alice", "Xenia").replace("Dover", "Calais")
    texts = [item, item.lower(), item.upper(), item.title(), re.sub("[.,:]", "", item), item.replace(".", ";").replace(",", " -"), item.replace(" ", "\n"), changed.lower(), changed]
    got = leaked(spark, item, *texts, "Nobody was there when it all began, and so it went on until late")
    assert {k for k, v in got.items() if v[0]} == set(range(len(texts)))
    assert {k for k, v in got.items() if v[2]} == {0, 1, 2, 3, 4, 6} | ({5} if got[5][2] else set())
    assert leaked(spark, QUESTION, LEAKS[1][1])[0] == (True, 21, False)


def test_names_that_begin_sentences_and_numbers_in_words(spark):
    item = "Natalia sold 48 clips to friends in April. Natalia sold 24 clips in May. How many clips did Natalia sell altogether?"
    assert leaked(spark, item, item.replace("Natalia", "Weng").replace("48", "30").replace("24", "12"))[0] == (True, 21, False)
    item = "John has 5 apples. Mary has 3 apples. Tom has 2 apples. How many apples do they have together?"
    other = "Anna has 7 apples. Carl has 4 apples. Lena has 6 apples. How many apples do they have together?"
    assert leaked(spark, item, other, "Lena: " + other.replace("7", "seven").replace("4", "twenty-four"))[0] == (True, 19, False)
    item = "There were three horses in the field and seven more came, then twenty five left and two hundred and six stayed"
    got = leaked(spark, item, item.replace("three", "3").replace("seven", "4").replace("twenty five", "31").replace("two hundred and six", "90"), item.replace("three", "3"))
    assert got == {0: (True, 17, False), 1: (True, 17, True)}
    # Words with a capital alone are a chance.
    assert leaked(spark, "A Long And Winding Title Of The Old Book About Seas And Ships And Wind", "Some Quite Other Heading With Many Words Here That Never Had To Do So Much") == {0: (False, 0, False)}


def test_codes_of_windows(spark):
    """Two windows have a code in common if all their words are the same or names, and the words are hashed by compiled code."""
    draw, kinds = np.random.default_rng(4), ["a", "b", "\x01n5", "\x01n7", "\x01pa", "\x01pb", "\x01qb"]
    texts = [[kinds[k] for k in draw.integers(0, 7, n)] for n in (3, 4, 9, 20, 30)] + [["a"] * 9, ["\x01pa"] * 9, []]
    frame = spark.createDataFrame(list(enumerate(texts)), "row int, words array<string>")
    width = 4
    for step in (1, 3):
        found = decontaminate.windows(frame, "words", width, step)
        assert "lambdafunction(xxhash64" not in found._jdf.queryExecution().optimizedPlan().toString()
        codes = collections.defaultdict(set)
        for r in found.collect():
            codes[r["row"], r["at"]].add(r["code"])
        own = {(n, at): t[at : at + width] for n, t in enumerate(texts) for at in range(0, len(t) - width + 1, step)}
        assert codes.keys() == own.keys()
        named = lambda w: w[:2] in ("\x01p", "\x01q")
        template = lambda w: w[2:] if named(w) else w[:2]
        fits = lambda v, w: template(v) == template(w) or named(v) and named(w)
        for one, left in own.items():
            assert len(codes[one]) == 2 ** sum(map(named, left))
            for other, right in own.items():
                assert bool(codes[one] & codes[other]) == all(map(fits, left, right))


def test_sharding(spark, docs, none):
    rows = sharding.sharded(docs, 3).collect()
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in AWKWARD)
    for k in range(3):
        own = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert own == list(range(len(own)))
    assert sharding.sharded(none, 3).count() == 0
    # A map is edited: versions stay, a new shard takes slots and no others change hands.
    loads = [(s, 100, 1) for s in range(0, sharding.SLOTS, 3)]
    first = sharding.rebalanced(loads, 24)
    grown = sharding.rebalanced(loads, 25, first)
    moved = {s for s in first if grown[s] != first[s]}
    assert moved and {grown[s] for s in moved} == {24}
    path = sharding.map_folder(spark)
    sharding.store_map(spark, path, sharding.map_rows(1, first, loads))
    sharding.store_map(spark, path, sharding.map_rows(2, grown, loads))
    assert sharding.read_map(spark, path, 1).filter("shard = 24").count() == 0 < sharding.read_map(spark, path, 2).filter("shard = 24").count()
    weights = collections.Counter()
    for s, b, _ in loads:
        weights[grown[s]] += b
    assert max(weights.values()) - min(weights.values()) <= 200


def test_resharding_documents(spark):
    """A stored map is edited by new documents: shards above the mean give slots away until all are even, and old versions stay."""
    path = sharding.map_folder(spark)
    first = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.lit(20)).alias("text"))
    old = {r["virtual_slot"]: r["shard"] for r in sharding.sharded(first, 4, path=path).collect()}
    heavy = first.withColumn("text", F.when(sharding.slot_of(F.col("doc_id")).isin([s for s, k in old.items() if k == 0]), F.repeat(F.lit("x"), F.lit(200))).otherwise(F.col("text")))
    rows = sharding.resharded(heavy, path).collect()
    new = {r["virtual_slot"]: r["shard"] for r in rows}
    assert len(rows) == 4000 and {r["map_version"] for r in rows} == {2}
    moved = {s for s in old if new[s] != old[s]}
    assert 0 in {old[s] for s in moved} and len(moved) < len(old)
    sizes, places = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert {r["slot"]: r["shard"] for r in sharding.read_map(spark, path, 1).collect() if r["slot_rows"]} == old
    fewer = sharding.resharded(heavy, path, 2).collect()
    assert {r["shard"] for r in fewer} == {0, 1} and {r["map_version"] for r in fewer} == {3} and len(fewer) == 4000


def test_write_shards(spark, docs):
    rows = sharding.records(docs)
    loads = sharding.slot_loads(rows)
    slot_map = sharding.store_map(spark, sharding.map_folder(spark), sharding.map_rows(1, sharding.rebalanced(loads, 3), loads))
    path = sharding.map_folder(spark) + "-out"
    sharding.write_shards(docs, slot_map, path)
    back = spark.read.parquet(path)
    assert back.count() == len(AWKWARD) and set(docs.columns) <= set(back.columns)


def cut(rows, window):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = collections.Counter()
    for i, t in rows:
        w = words(t)
        lost = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                lost[k : k + window] = [True] * window
        out[i, len(w), sum(lost), b" ".join(x for x, gone in zip(w, lost, strict=True) if not gone).decode()] += 1
    return out


@pytest.mark.parametrize(("block", "window"), [(7, 13), (3, 5), (2, 5)])
def test_removed_spans(spark, docs, none, block, window):
    draw = np.random.default_rng(block)
    passages = [[f"p{k}-{j}" for j in range(window + 4 * k)] for k in range(4)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(draw.integers(1, 5)):
            text += [f"u{k}" for k in draw.integers(0, 50, draw.integers(0, 12))]
            p = passages[draw.integers(0, 4)]
            a = draw.integers(0, 3)
            text += p[a : a + draw.integers(window - 1, window + 9)]
        rows.append((i // 2 if i % 10 == 0 else i, " ".join(text)))  # some ids come twice
    got = substring_dedup.removed_spans(spark.createDataFrame(rows, "doc_id bigint, text string"), block, window).collect()
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == cut(rows, window)
    assert all(sum(b - a for a, b in r["removed"]) == r["n_removed"] for r in got)
    if block == 7:
        got = substring_dedup.removed_spans(docs, block, window).collect()
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == cut(AWKWARD, window)
        assert substring_dedup.removed_spans(none, block, window).count() == 0


def test_a_window_holds_a_block(docs):
    with pytest.raises(ValueError, match="block"):
        substring_dedup.removed_spans(docs, block=7, window=12)


def test_quality(spark, docs, none):
    good = [(i, "It is a fine day, and the words go on as they should. " * (1 + i % 4)) for i in range(100)]
    poor = [(1000 + i, "BUY!! NOW!! " * (3 + i % 5)) for i in range(30)]
    frame = spark.createDataFrame(good + poor, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in good + poor] + [(None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.quality_model(frame, labels, may_learn=id_remainder(5) != 0)
    rows = {r["doc_id"]: r["score"] for r in quality.scored(frame, model).collect()}
    assert min(rows[i] for i, _ in good) >= 0.3 > max(rows[i] for i, _ in poor)
    odd = quality.scored(docs.withColumn("text", F.coalesce("text", F.lit(""))), model).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.scored(none, model).count() == 0
    blank = quality.quality_model(frame, labels.limit(0), may_learn=F.lit(True))
    assert {round(r["score"], 6) for r in quality.scored(frame, blank).collect()} == {0.3}
    one_kind = quality.quality_model(frame, labels.filter("quality = 1"), may_learn=F.lit(True))
    assert {round(r["score"], 6) for r in quality.scored(frame, one_kind).collect()} == {0.3}


def test_quality_learns_from_every_row_and_pair(spark):
    # The poor rows are those that a sample of 20,000 by hash would leave out.
    ids = [r["id"] for r in spark.range(20_060).orderBy(F.xxhash64("id"), "id").collect()]
    poor = spark.createDataFrame([(i, "BUY!! NOW!!", 0) for i in ids[20_000:]], "doc_id bigint, text string, quality int")
    rows = spark.createDataFrame([(i, "It is a fine day.", 1) for i in ids[:20_000]], poor.schema).union(poor)
    model = quality.quality_model(rows, rows, may_learn=F.lit(True))
    scores = {r["text"]: r["score"] for r in quality.scored(rows, model).select("text", "score").distinct().collect()}
    assert scores["BUY!! NOW!!"] < 0.3 <= scores["It is a fine day."]
    # The slope over all pairs, one by one, vanishes.
    draw = np.random.default_rng(3)
    texts = [(i, " ".join(draw.choice(["day", "BUY!!", "a", "notwithstanding", "12"], 5 + i % 9)), int(draw.random() < 0.6)) for i in range(120)]
    frame = spark.createDataFrame(texts, poor.schema)
    model = quality.quality_model(frame, frame, may_learn=F.lit(True))
    bent = model.bent(quality.features(pa.array([t for _, t, _ in texts])))
    label = np.array([q for _, _, q in texts])
    diff = (bent[label == 1][:, None] - bent[label == 0]).reshape(-1, bent.shape[1])
    slope = -((1 / (1 + np.exp(diff @ model.weights))) @ diff) / len(diff) + 1e-3 * model.weights
    assert np.abs(slope).max() < 1e-3
    assert np.isclose((bent @ model.weights < model.cut).mean(), (label == 0).mean(), atol=0.01)


def test_quality_labels_meet_features_and_not_texts(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "written", lambda df: taken.append(df) or df)
    frame = spark.createDataFrame([(1, "a fine day"), (1, "a fine day"), (2, "BUY!!"), (3, ""), (4, "no label"), (5, "held out"), (None, "no id")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (3, 0), (5, 1), (None, 1), (4, None)], "doc_id bigint, quality int")
    found = quality.labelled_features(frame, labels, "quality", F.coalesce(F.col("doc_id") != 5, F.lit(True))).collect()
    expected = quality.features(pa.array(["a fine day", "a fine day", "BUY!!", ""])).tolist()
    assert sorted((r["label"], r["x"]) for r in found) == sorted(zip([1, 1, 0, 0], expected, strict=True))
    # The join is above the step that reads the texts, so what it exchanges has no text.
    plan = taken[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("MapInArrow")


def test_token_files(spark, docs, none):
    path = token_files.token_folder(spark)
    token_files.write_token_files(docs, path, vocabulary("byte_bpe_50k.json"), 0, files=3, page_rows=2)
    rows = token_files.id_checksums(token_files.read_token_files(spark, path)).collect()
    expected = []
    for i, t in AWKWARD:
        ids = np.array([*encoded("byte_bpe_50k.json", t), 0], "<u4")
        expected.append((-1 if i is None else i, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(expected)
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    by_start = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in sorted(rows, key=lambda r: r["start"])]
    assert by_start == sorted(by_start)
    # One document's ids, without reading the others.
    one = spark.read.parquet(path).filter("doc_id = 8").select("ids").collect()
    assert one[0]["ids"] == [*encoded("byte_bpe_50k.json", "one two"), 0]
    empty = token_files.token_folder(spark)
    token_files.write_token_files(none, empty, vocabulary("byte_bpe_50k.json"), 0)
    assert token_files.read_token_files(spark, empty).count() == 0


PAGES = [
    (1, "http://a.example/x?y=1", "<!DOCTYPE html><html lang=\"de\"><head><title>T &amp; <b>U</b></title><style>p{}</style><script>var t='</p>';</script></head><body><!-- no --><p>Hé &lt;llo<br>there</p><a href='/q?a=1&amp;b=2'>link</a></body></html>"),
    (2, None, None), (3, "http://b.example/", ""), (None, "http://c.example/\r\nX: y", "plain < text & more"), (4, "http://d.example/", "<script>never closed"), (4, "http://d.example/", "<script>never closed"),
    (5, "http://e.example/", "<p>" + "word " * 50_000 + "</p>"), (6, "http://f.example/", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
]


def test_warc(spark):
    pages = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in PAGES], "page_id bigint, url string, html string, date string, value string").repartition(2)
    source = warc.responses(pages, "2024-01-01T00:00:00Z")
    path = warc.record_folder(spark)
    warc.write_records(warc.derived(source), path, records_per_file=5)
    rows = warc.read_records(spark, path).collect()
    assert len(rows) == 2 * len(PAGES) and all(r["digest_ok"] for r in rows)
    ids = {r["record_id"] for r in source.collect()}
    assert len(ids) == len(PAGES) - 1 and {r["refers_to"] for r in rows} == ids
    text = {r["page_id"]: r["block"] for r in rows if r["record_type"] == "conversion"}
    assert text[1] == "T & U\nHé <llo\nthere\nlink" and text[2] == "" and text[3] == "" and text[4] == "" and text[None] == "plain < text & more"
    assert text[6] == "a\nWARC/1.1\nb" and text[5].count("word") == 50_000
    about = next(r for r in rows if r["record_type"] == "metadata" and r["page_id"] == 1)
    assert "title: T & <b>U</b>\r\n" in about["block"] and "outlink: /q?a=1&b=2\r\n" in about["block"] and "language: de\r\n" in about["block"]
    digests = {r["page_id"]: r["source_digest"] for r in rows if r["record_type"] == "conversion"}
    assert digests[1] == warc.digest(PAGES[0][2].encode()) and about["source_digest"] == digests[1]
    empty = warc.record_folder(spark)
    warc.write_records(warc.derived(warc.responses(pages.limit(0), "2024-01-01T00:00:00Z")), empty)
    assert warc.read_records(spark, empty).count() == 0


def thue_morse(n):
    """Two words of ``2 ** n`` letters, each the other's mirror, which every polynomial modulo 2^64 takes for equal from some length on."""
    bits = [bin(i).count("1") & 1 for i in range(1 << n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_long_patterns_and_special_tokens(name):
    import pyarrow as pa

    from spanloom.llm.encoding import Encoder

    texts = [w for n in (5, 6, 10, 11) for w in thue_morse(n)]
    texts += ["a <|endoftext|> b", "<|startoftext|>x", "<|ENDOFTEXT|>", "<|endoftext|>", "x<|endoftext|>y plain words", "plain words 12 isn't   it?", "É é\tẞß ñandú İstanbul", "", None, "甲乙 words", "a b", "caf\xe9\xa0x «y»"]
    flat, counts = Encoder(vocabulary(name)).encode(pa.array(texts * 2))
    ends = np.cumsum(counts)
    assert [flat[e - n : e].tolist() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)] == [encoded(name, t) for t in texts * 2]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_any_mix_of_characters(name, monkeypatch):
    from spanloom.llm import encoding
    from tokenizers import Tokenizer

    monkeypatch.setattr(encoding, "UNITS_KEPT", 100)
    monkeypatch.setattr(encoding, "IDS_KEPT", 300)
    draw, encoder, whole = np.random.default_rng(7), encoding.Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    letters = [*"abzAZéßñŐɏ×÷ǃ'',.-!?&#(_19 \n\t  ", "\u0301", "\u0240", "“", "甲", "Я", "\xa0", "\xb5", "'s", "'ll ", "<|endoftext|>"]
    odds = np.array([1.0] * (len(letters) - 9) + [0.1] * 9)
    for _ in range(12):
        texts = ["".join(draw.choice(letters, n, p=odds / odds.sum())) for n in draw.integers(0, 40, 60)]
        flat, counts = encoder.encode(pa.array(texts))
        ends = np.cumsum(counts)
        assert [flat[e - n : e].tolist() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoder.units.codes) <= 100 and len(encoder.units.ids) <= 300
    flat, counts = encoder.encode(pa.array([], pa.string()))
    assert not len(flat) and not len(counts)


def test_recurring_words_are_encoded_once(monkeypatch):
    from spanloom.llm import encoding

    monkeypatch.setattr(encoding, "UNITS_KEPT", 400)
    encoder, calls = encoding.Encoder(vocabulary("byte_bpe_50k.json")), collections.Counter()
    model, whole = encoder.model, encoder.whole

    class Counted:
        def tokenize(self, spelt):
            calls[spelt] += 1
            return model.tokenize(spelt)

    encoder.model = Counted()
    often = [f"recurring{chr(97 + i)}" for i in range(20)]
    for n in range(30):
        once = [f"new{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
        text = " " + " ".join([*(w + "" ",.;?"[n % 5 - 1 : n % 5] for w in often), *once])
        flat, _ = encoder.encode(pa.array([text]))
        assert flat.tolist() == whole.encode(text, add_special_tokens=False).ids
    # Neither the marks behind them nor the words that came once make them new.
    assert {calls["Ġ" + w] for w in often} == {1}


def peak_mb(work):
    """What Python and numpy hold at most while ``work`` runs, and its result."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_memory_does_not_follow_the_slice():
    from spanloom.llm.encoding import Encoder

    draw = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(500)])
    texts = [None, "", *[" ".join(words[draw.integers(0, 500, 300)]) for _ in range(2300)]]
    column = pa.array(texts)
    assert column.nbytes > 1.4 * 2**21
    encoder = Encoder(vocabulary("word_bpe_49k.json"))
    parts = [encoder.encode(column.slice(i, 100)) for i in range(0, len(texts), 100)]
    (ids, counts), most = peak_mb(lambda: encoder.encode(column))
    assert most < 80
    assert ids.tolist() == np.concatenate([p[0] for p in parts]).tolist() and counts.tolist() == np.concatenate([p[1] for p in parts]).tolist()
    sums, most = peak_mb(lambda: [(len(c), c.sum()) for c in jaccard_join.shingle_sets(column, 5)])
    assert most < 50
    assert sums == [(len(c), c.sum()) for i in range(0, len(texts), 100) for c in jaccard_join.shingle_sets(column.slice(i, 100), 5)]


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    sizes = spark.sparkContext.accumulator(0)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def seen(batches, most=0):
        for batch in batches:
            sizes.add(batch.nbytes > 2 * common.BATCH_BYTES)
            yield from common.slices([batch], most=most or common.SLICE_BYTES)

    monkeypatch.setattr(packing, "slices", seen)
    monkeypatch.setattr(quality, "slices", lambda batches, most: seen(batches, most))
    rows = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.repeat(F.lit(" ab"), 2000)).alias("text"))
    assert packing.packed_documents(rows, vocabulary("word_bpe_49k.json"), 2).count() == 3000
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    assert quality.labelled_features(rows, labels, "quality", F.lit(True)).count() == 3000
    assert sizes.value == 0
    assert spark.conf.get(key) == before


def test_codes_of_long_patterns():
    import pyarrow as pa

    from spanloom.llm.words import Words

    for n in (10, 11, 12):
        for lower in (False, True):
            one, other = Words(pa.array(list(thue_morse(n))), lower).code.tolist()
            assert one != other
    same = Words(pa.array(["X" * 500, "x" * 500, "x" * 500 + " y"]), lower=True)
    assert len(set(same.code.tolist())) == 2


def test_short_and_unspaced_items(spark):
    """Items of few words are found whole and as they are, those of scripts without blanks by their letters."""
    items = [(1, "Name the capital"), (2, "7 + 5"), (3, "北京是中国的首都吗"), (4, ""), (5, None), (6, "東京")]
    docs = [
        (1, "Please NAME the capital, now"), (2, "name a capital"), (3, "What is 7 + 5?"), (4, "What is 7 + 6?"), (5, "問：北京是中国的首都吗？"), (6, "北京不是中国的首都"),
        (7, "我在東京都"), (8, "京東"), (9, None), (10, ""), (11, "the capital"), (None, "name the capital"), (12, "unnamed the capitals"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r["item_id"] for r in decontaminate.leaks(frame, bench).collect() if r["contaminated"]}
    assert got == {1: 1, 3: 2, 5: 3, 7: 6, None: 1}
    kept = decontaminate.without_leaks(frame.withColumn("leak_key", F.lit("x")), bench)
    assert {r["doc_id"] for r in kept.collect()} == {2, 4, 6, 8, 9, 10, 11, 12}
