"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation in numpy.

The model predicts units: the most frequent words, the end of a text, and classes of the other words by their last
two bytes. A context is the previous units, each a vector weighted by its distance; a unit's logit is the product
with its own vector plus a bias, and matrix products over a batch of contexts give normalised log-probabilities.
A word of a class has its share of the class, by counts over all training texts with one added to each and to what
was never seen, so the probabilities of all words add up to one.

Counts, vocabulary and training cover every training text. Tasks train from one start on their own texts, and their
parameters are averaged by the tokens seen. Counts of frequent words are sent along (a fixed number of words), those
of the others are met by their fingerprint in an exchange, added up per task before it.

Cases: a NULL or empty text is its end alone; rows without an id are scored and are not held out; repeated rows are
scored each; without training texts all words are unknown and the model is uniform; an empty table gives no rows;
very long texts are scored whole; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, packets, parts_for, raw, runs, slices, written
from .words import U64, Words, mix

#: Word units, suffix classes, units of context, and the length of a unit's vector.
WORD_UNITS, CLASSES, CONTEXT, WIDTH = 191, 64, 4, 16
UNITS = WORD_UNITS + 1 + CLASSES
#: Words whose counts every task has.
SENT_WORDS = 60_000
BUCKET_BYTES = 32_000_000
_END = U64(0x2545F4914F6CDD1D)  # stands for the end of a text


@dataclass
class Vocabulary:
    units: np.ndarray  # fingerprints of the word units and the end, sorted
    words: np.ndarray  # fingerprints with counts that are sent, sorted
    counts: np.ndarray
    class_logs: np.ndarray  # log10 of tokens + words + 1 of each class, without the word units
    unit_share: np.ndarray  # share of each unit among training tokens
    tokens: int
    distinct: int


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, code, suffix class)`` of all tokens, each text's end after its words."""
    words = Words(column, lower=True)
    n = len(words.count)
    lowered = words.data.copy()
    lowered[(lowered >= 65) & (lowered <= 90)] += 32
    last = lowered[words.end - 1].astype(U64)
    before = np.where(words.end - words.start > 1, lowered[words.end - 2], 0).astype(U64) if len(words) else last
    suffix = (mix(last * U64(256) + before + U64(1)) % U64(CLASSES)).astype(np.uint8)
    at = words.first[1:]
    return np.insert(words.doc, at, np.arange(n)), np.insert(words.code, at, _END), np.insert(suffix, at, 0)


def word_counts(training: DataFrame, buckets: int) -> DataFrame:
    """A row for each bucket of words: ``codes, counts, classes`` as raw bytes, sorted by code, and ``tokens, words`` in it."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            _, code, suffix = tokens_of(part["text"])
            codes, first, counts = np.unique(code, return_index=True, return_counts=True)
            yield packets(((codes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64), {"codes": codes, "counts": counts.astype("<i8"), "classes": suffix[first]})

    def add(table: pa.Table) -> pa.Table:
        codes, counts, classes = raw(table["codes"], "<u8"), raw(table["counts"], "<i8"), raw(table["classes"], "u1")
        order = np.argsort(codes, kind="stable")
        first, _ = runs(codes[order])
        total = np.add.reduceat(counts[order], first) if len(first) else counts
        return pa.table({"bucket": table["bucket"][:1], "codes": [codes[order][first].tobytes()], "counts": [total.astype("<i8").tobytes()], "classes": [classes[order][first].tobytes()], "tokens": [int(total.sum())], "words": [len(first)]})

    sent = training.mapInArrow(count, "bucket bigint, codes binary, counts binary, classes binary")
    return sent.groupBy("bucket").applyInArrow(add, "bucket bigint, codes binary, counts binary, classes binary, tokens bigint, words bigint")


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """The model's units and what is sent to every task; the driver sees the most frequent words and a row per class."""

    def most(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, n, classes = (np.frombuffer(batch[c][i].as_py(), k) for c, k in (("codes", "<i8"), ("counts", "<i8"), ("classes", "u1")))
                top = np.argsort(-n, kind="stable")[:SENT_WORDS]
                yield pa.RecordBatch.from_arrays([pa.array(codes[top]), pa.array(n[top]), pa.array(classes[top].astype(np.int32))], ["code", "n", "class"])

    def by_class(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, classes = np.frombuffer(batch["counts"][i].as_py(), "<i8"), np.frombuffer(batch["classes"][i].as_py(), "u1")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(CLASSES), pa.int32()), pa.array(np.bincount(classes, weights=n, minlength=CLASSES).astype(np.int64)), pa.array(np.bincount(classes, minlength=CLASSES), pa.int64())],
                    ["class", "n", "v"],
                )

    top = counts.mapInArrow(most, "code bigint, n bigint, class int").orderBy(F.desc("n"), "code").limit(SENT_WORDS).toArrow()
    code, n, kind = (top[c].to_numpy() for c in ("code", "n", "class"))
    code = code.view(U64)
    sums = counts.mapInArrow(by_class, "class int, n bigint, v bigint").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in sums:
        class_n[r["class"]], class_v[r["class"]] = r["n"], r["v"]
    tokens, distinct = int(class_n.sum()), int(class_v.sum())
    chosen = np.flatnonzero(code != _END)[:WORD_UNITS]
    np.subtract.at(class_n, kind[chosen], n[chosen])
    np.subtract.at(class_v, kind[chosen], 1)
    end = np.flatnonzero(code == _END)
    ends = int(n[end[0]]) if len(end) else 0
    if ends:
        class_n[kind[end[0]]] -= ends
        class_v[kind[end[0]]] -= 1
    units = np.append(code[chosen], _END)
    share = np.append(n[chosen], ends)
    order = np.argsort(units)
    unit_share = np.zeros(UNITS)
    unit_share[: len(units)] = share[order]
    unit_share[WORD_UNITS + 1 :] = class_n
    by_code = np.argsort(code)
    return Vocabulary(units[order], code[by_code], n[by_code], np.log10(class_n + class_v + 1.0), (unit_share + 1) / (unit_share.sum() + UNITS), tokens, distinct)


def units_of(code: np.ndarray, suffix: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    at = np.minimum(np.searchsorted(vocabulary.units, code), len(vocabulary.units) - 1)
    return np.where(vocabulary.units[at] == code, at, WORD_UNITS + 1 + suffix)


def contexts_of(unit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The previous units of each token, nearest first; ``UNITS`` stands for what lies before a text."""
    out = np.full((len(unit), CONTEXT), UNITS)
    for k in range(1, CONTEXT + 1):
        same = doc[k:] == doc[:-k]
        out[k:, k - 1][same] = unit[:-k][same]
    return out


class LogBilinear:
    """Unit vectors in and out, distance weights, and biases."""

    def __init__(self, unit_share: np.ndarray, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.inner = draw.normal(0, 0.3, (UNITS + 1, WIDTH)).astype(np.float32)
        self.outer = draw.normal(0, 0.1, (UNITS, WIDTH)).astype(np.float32)
        self.distance = np.full((CONTEXT, WIDTH), 0.5, np.float32)
        self.bias = np.log(unit_share).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.inner, self.outer, self.distance, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def predicted(self, context: np.ndarray) -> np.ndarray:
        total = self.inner[context[:, 0]] * self.distance[0]
        for k in range(1, CONTEXT):
            total += self.inner[context[:, k]] * self.distance[k]
        return total

    def log_probabilities(self, context: np.ndarray, unit: np.ndarray, batch: int = 8192) -> np.ndarray:
        """Natural logarithms of the normalised probabilities."""
        out = np.empty(len(unit))
        outer = np.ascontiguousarray(self.outer.T)
        for a in range(0, len(unit), batch):
            logits = self.predicted(context[a : a + batch]) @ outer
            logits += self.bias
            own = logits[np.arange(len(logits)), unit[a : a + batch]].astype(float)
            most = logits.max(1, keepdims=True)
            logits -= most
            np.exp(logits, out=logits)
            out[a : a + batch] = own - most[:, 0] - np.log(logits.sum(1, dtype=np.float64))
        return out


class NoiseContrast:
    """Gradient steps that tell tokens from noise drawn by the units' shares; the normaliser is held at one."""

    def __init__(self, model: LogBilinear, share: np.ndarray, noise: int = 24, rate: float = 0.08, seed: int = 5):
        self.model, self.noise, self.rate = model, noise, rate
        self.log_noise = np.log(noise * share).astype(np.float32)
        self.cumulated, self.draw = np.cumsum(share / share.sum()), np.random.default_rng(seed)
        self.squares = [np.full_like(p, 1e-2) for p in model.parameters()]

    def step(self, context: np.ndarray, unit: np.ndarray) -> None:
        m, n = self.model, len(unit)
        drawn = np.minimum(np.searchsorted(self.cumulated, self.draw.random(self.noise)), UNITS - 1)
        inner = [m.inner[context[:, k]] for k in range(CONTEXT)]
        hidden = sum(x * m.distance[k] for k, x in enumerate(inner))
        own = (hidden * m.outer[unit]).sum(1) + m.bias[unit] - self.log_noise[unit]
        other = hidden @ m.outer[drawn].T + (m.bias[drawn] - self.log_noise[drawn])
        up = (1 / (1 + np.exp(np.clip(own, -30, 30)))).astype(np.float32)  # 1 - sigmoid
        down = (-1 / (1 + np.exp(np.clip(-other, -30, 30)))).astype(np.float32)
        to_hidden = up[:, None] * m.outer[unit] + down @ m.outer[drawn]
        weighted = up[:, None] * hidden
        outer = np.stack([np.bincount(unit, weights=weighted[:, d], minlength=UNITS) for d in range(WIDTH)], 1)
        np.add.at(outer, drawn, down.T @ hidden)
        bias = np.bincount(unit, weights=up, minlength=UNITS)
        np.add.at(bias, drawn, down.sum(0))
        distance = np.stack([(to_hidden * x).sum(0) for x in inner])
        inward = np.zeros((UNITS + 1, WIDTH))
        for k in range(CONTEXT):
            part = to_hidden * m.distance[k]
            for d in range(WIDTH):
                inward[:, d] += np.bincount(context[:, k], weights=part[:, d], minlength=UNITS + 1)
        for p, g, s in zip(m.parameters(), [inward, outer, distance, bias], self.squares, strict=True):
            g = (g / n).astype(np.float32)
            s += g * g
            p += self.rate * g / np.sqrt(s)


def trained(training: DataFrame, vocabulary: Vocabulary, batch: int = 4096) -> LogBilinear:
    """One pass over all training texts in every task, then the mean by tokens; the driver sees one row for each parameter."""
    start = LogBilinear(vocabulary.unit_share)
    sent = training.sparkSession.sparkContext.broadcast(vocabulary)

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = sent.value, 0
        model = LogBilinear(vocabulary.unit_share)
        contrast = NoiseContrast(model, vocabulary.unit_share)
        for part in slices(batches):
            doc, code, suffix = tokens_of(part["text"])
            unit = units_of(code, suffix, vocabulary)
            context = contexts_of(unit, doc)
            mixed = np.random.default_rng(len(unit)).permutation(len(unit))
            for a in range(0, len(unit), batch):
                own = mixed[a : a + batch]
                contrast.step(context[own], unit[own])
            seen += len(unit)
        if seen:
            flat = model.flat().astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))], ["at", "value", "weight"])

    sums = training.select("text").mapInArrow(learn, "at int, value double, weight double").groupBy("at").agg((F.sum("value") / F.sum("weight")).alias("value"))
    found = sums.toArrow()
    if not found.num_rows:
        return start
    flat = np.zeros(len(start.flat()))
    flat[found["at"].to_numpy()] = found["value"].to_numpy()
    return start.load(flat)


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row; rows that ``held_out`` names are not learnt from."""
    docs = id_and_text(docs, id_col, text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    training = docs.filter("NOT held_out").select("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(size, BUCKET_BYTES, 2)
    counts = written(word_counts(training, buckets))
    vocabulary = vocabulary_of(counts)
    model = trained(training, vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, model.flat()))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = sent.value
        model = LogBilinear(vocabulary.unit_share).load(flat)
        number = TaskContext.get().partitionId() << 33
        for part in slices(batches):
            n = part.num_rows
            doc, code, suffix = tokens_of(part["text"])
            unit = units_of(code, suffix, vocabulary)
            log10 = model.log_probabilities(contexts_of(unit, doc), unit) / np.log(10)
            in_class = unit > WORD_UNITS
            log10[in_class] -= vocabulary.class_logs[unit[in_class] - WORD_UNITS - 1]
            at = np.minimum(np.searchsorted(vocabulary.words, code), max(0, len(vocabulary.words) - 1))
            here = vocabulary.words[at] == code if len(vocabulary.words) else np.zeros(len(code), bool)
            count_log = np.zeros(len(code))
            count_log[here] = np.log10(vocabulary.counts[at[here]] + 1.0)
            sums = [np.bincount(doc, weights=w, minlength=n) for w in (log10 + np.where(in_class, count_log, 0), count_log)]
            columns = {
                "slice": pa.array(np.full(n, number)), "at": pa.array(np.arange(n), pa.int32()), "doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": pa.array(np.bincount(doc, minlength=n), pa.int64()),
                "known": pa.array(np.bincount(doc, weights=here, minlength=n).astype(np.int64)), "model_log": pa.array(sums[0]), "count_log": pa.array(sums[1]),
            }
            none = [pa.nulls(n, k) for k in (pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns.values(), *none], [*columns, "bucket", "codes", "rows"])
            rare = ~here
            if rare.any():
                dealt = packets(((code[rare] >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64), {"codes": code[rare], "rows": doc[rare].astype("<i4")})
                blank = [pa.nulls(dealt.num_rows, c.type) for c in list(columns.values())[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(dealt.num_rows, number)), *blank, *dealt.columns], [*columns, "bucket", "codes", "rows"])
            number += 1

    head = "slice bigint, at int, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, model_log double, count_log double"
    stage = written(docs.mapInArrow(score, f"{head}, bucket bigint, codes binary, rows binary"))

    def look_up(rare: pa.Table, known: pa.Table) -> pa.Table:
        """For each slice the known tokens and the sum of logarithms of its rows, as raw bytes."""
        have, n = raw(known["codes"], "<u8"), raw(known["counts"], "<i8")
        if not len(have):
            have, n = np.zeros(1, U64), np.zeros(1, np.int64)
        out = []
        for origin, codes, rows in zip(rare["slice"].to_pylist(), rare["codes"].to_pylist(), rare["rows"].to_pylist(), strict=True):
            codes, rows = np.frombuffer(codes, "<u8"), np.frombuffer(rows, "<i4")
            at = np.minimum(np.searchsorted(have, codes), len(have) - 1)
            count = np.where(have[at] == codes, n[at], 0)
            first, _ = runs(rows)  # rows are in order
            out.append((origin, rows[first].tobytes(), np.add.reduceat((count > 0).astype("<i4"), first).astype("<i4").tobytes(), np.add.reduceat(np.log10(count + 1.0), first).tobytes()))
        return pa.table({"slice": pa.array([o[0] for o in out], pa.int64()), **{c: pa.array([o[k] for o in out], pa.binary()) for k, c in ((1, "rows"), (2, "known"), (3, "logs"))}})

    rare = stage.filter("bucket IS NOT NULL").select("bucket", "slice", "codes", "rows").groupBy("bucket")
    met = rare.cogroup(counts.select("bucket", "codes", "counts").groupBy("bucket")).applyInArrow(look_up, "slice bigint, rows binary, known binary, logs binary")

    def add(rows: pa.Table, told: pa.Table) -> pa.Table:
        n = rows.num_rows
        at, known, logs = raw(told["rows"], "<i4"), raw(told["known"], "<i4"), raw(told["logs"], "<f8")
        order = pa.array(np.argsort(rows["at"].to_numpy()))
        rows = rows.take(order).drop_columns(["slice", "at"])
        return rows.append_column("rare_known", pa.array(np.bincount(at, weights=known, minlength=n).astype(np.int64))).append_column("rare_log", pa.array(np.bincount(at, weights=logs, minlength=n).astype(np.float64)))

    heads = stage.filter("bucket IS NULL").select("slice", "at", "doc_id", "held_out", "n_tokens", "known", "model_log", "count_log").groupBy("slice")
    joined = heads.cogroup(met.groupBy("slice")).applyInArrow(add, head.removeprefix("slice bigint, at int, ") + ", rare_known bigint, rare_log double")
    base = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("count_log") + F.col("rare_log") - F.col("n_tokens") * F.lit(base)).alias("base_score"), (F.col("model_log") + F.col("rare_log")).alias("score"),
    )
