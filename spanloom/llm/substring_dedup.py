"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping blocks of ``block`` words, and each rolling window of that length is probed
against them. A repeat of ``2 block - 1`` words or more holds a whole block of either document, so the windows around
the hits are all that can repeat. They are compared in full length; where a window also begins in a document with
a smaller id its words go, and overlapping windows add up to the maximal exact repeat.

Anchors that recur within one slice of texts are hits at once and go to the exchange as one entry, so a passage that
very many documents share does not gather in one task.

Cases: a NULL text has no words; fewer words than a window: nothing goes; of rows with one id none removes words of
the other; rows without an id neither remove nor lose words; an empty table gives no rows; very long texts are taken
whole; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, id_and_text, packets, parts_for, raw, runs, slices, written
from .words import U64, Words, mix

#: Words of text per exchange bucket; buckets grow in number with the data.
BUCKET_BYTES = 8_000_000
#: Documents whose hits come back together.
GROUP_DOCS = 5000
#: Documents of one file of the written tables.
TABLE_ROWS = 10_000


#: The bits of a code that are sent.
SHORT = U64((1 << 48) - 1)


def short(codes: np.ndarray) -> np.ndarray:
    """The lower six bytes of each code, as rows of bytes."""
    return np.ascontiguousarray(codes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].copy().view("V6").ravel()


def long(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = data.reshape(-1, 6)
    return wide.view("<u8").ravel()


def anchors(docs: DataFrame, block: int) -> DataFrame:
    """``doc_id, anchors``: fingerprints of each document's windows of ``block`` words that hit a block of another document.

    A row for each document with hits. More than the true hits may come, never fewer.
    """
    size, n_docs = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    buckets, groups = parts_for(size or 0, BUCKET_BYTES, 4), parts_for(n_docs, GROUP_DOCS)

    def group_of(owners: np.ndarray) -> np.ndarray:
        """Hits come back to groups of documents, packed, and not as a row for each document and bucket."""
        return ((mix(owners.astype("<i8").view(U64)) >> U64(32)) * U64(groups) >> U64(32)).astype(np.int64)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(part["text"])
            at, codes = words.windows(block)
            doc = words.doc[at]
            # The lowest bit says that the window is one of its document's blocks.
            marked = (codes & ~U64(1)) | ((at - words.first[doc]) % block == 0).astype(U64)
            order = np.argsort(codes >> U64(1), kind="stable")
            marked, doc = marked[order], doc[order]
            # Once for each document that has it.
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (marked[1:] >> U64(1) != marked[:-1] >> U64(1))
            marked = np.bitwise_or.reduceat(marked, np.flatnonzero(new)) if len(marked) else marked
            doc = doc[new]
            begins, lengths = runs(marked >> U64(1))
            ids = part["doc_id"].to_numpy()
            alone = lengths == 1
            # Once in this slice: the exchange decides.
            single = begins[alone]
            entry, owner, known = marked[single], ids[doc[single]], np.zeros(len(single), np.int8)
            if not alone.all():
                # In several documents: hits here at once; one entry tells the others.
                blocks = np.bitwise_or.reduceat(marked, begins)[~alone]
                entry = np.concatenate([entry, blocks])
                owner = np.concatenate([owner, ids[doc[begins[~alone]]]])
                known = np.concatenate([known, np.ones(len(blocks), np.int8)])
                again = np.repeat(~alone, lengths)
                hit_doc, hit = doc[again], (marked[again] & SHORT) >> U64(1)
                by_doc = np.argsort(hit_doc, kind="stable")
                found = ids[hit_doc[by_doc]].astype(np.int64)
                told = packets(group_of(found), {"doc_id": found, "anchors": short(hit[by_doc])})
                blank = [pa.nulls(told.num_rows, pa.binary())] * 3
                yield pa.RecordBatch.from_arrays([pa.array(told["bucket"].to_numpy() % buckets), *blank, *told.columns], ["bucket", "entry", "owner", "known", "doc_group", "doc_id", "anchors"])
            # In the order of the owners, which then take little room; of the code 48 bits besides its bucket, as more hits than true ones do no harm.
            order = np.argsort(owner, kind="stable")
            entry, owner, known = entry[order], owner[order], known[order]
            bucket = ((entry >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            sent = packets(bucket, {"entry": short(entry), "owner": owner.astype(np.int64), "known": known})
            n = sent.num_rows
            yield pa.RecordBatch.from_arrays([*sent.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], [*sent.schema.names, "doc_group", "doc_id", "anchors"])

    def meet(table: pa.Table) -> pa.Table:
        entry, owner, known = long(raw(table["entry"], "u1")), raw(table["owner"], "<i8"), raw(table["known"], "i1")
        order = np.argsort(entry, kind="stable")
        entry, owner, known = entry[order], owner[order], known[order]
        begins, lengths = runs(entry >> U64(1))
        if len(begins):
            hit = (lengths > 1) & (np.bitwise_or.reduceat(entry & U64(1), begins) == 1)
            chosen = np.repeat(hit, lengths) & (known == 0)
            entry, owner = entry[chosen] >> U64(1), owner[chosen]
        by_owner = np.argsort(owner, kind="stable")
        entry, owner = entry[by_owner], owner[by_owner]
        here = packets(group_of(owner), {"doc_id": owner, "anchors": short(entry)})
        here = pa.Table.from_batches([here]).rename_columns(["doc_group", "doc_id", "anchors"])
        return pa.concat_tables([here, table.filter(table["doc_group"].is_valid()).select(["doc_group", "doc_id", "anchors"])])

    def gather(table: pa.Table) -> pa.Table:
        owner, hits = raw(table["doc_id"], "<i8"), raw(table["anchors"], "V6")
        order = np.argsort(owner, kind="stable")
        owner, hits = owner[order], hits[order]
        first, _ = runs(owner)
        return pa.table({"doc_id": owner[first], "anchors": binaries(hits, np.append(first, len(owner)))})

    sent = docs.filter("doc_id IS NOT NULL").mapInArrow(deal, "bucket bigint, entry binary, owner binary, known binary, doc_group bigint, doc_id binary, anchors binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "doc_group bigint, doc_id binary, anchors binary")
    return met.groupBy("doc_group").applyInArrow(gather, "doc_id bigint, anchors binary")


def anchored_windows(words: Words, row: int, anchors: np.ndarray, block: int, window: int) -> np.ndarray:
    """The windows of ``window`` words of one text that hold an anchor, as word positions in the text."""
    n = int(words.count[row])
    if n < window or not len(anchors):
        return np.zeros(0, np.int64)
    at, codes = words.block_windows
    lo, hi = np.searchsorted(at, [words.first[row], words.first[row + 1]])
    hit = np.isin((codes[lo:hi] & SHORT) >> U64(1), anchors)
    reach = np.zeros(n + 1, np.int64)
    reach[1 : len(hit) + 1] = np.cumsum(hit)
    reach[len(hit) + 1 :] = reach[len(hit)]
    starts = np.arange(n - window + 1)
    return starts[reach[np.minimum(starts + window - block + 1, n)] > reach[starts]]


def _cut(words: Words, row: int, lost: np.ndarray, data: bytes) -> bytes:
    """A text's words that are not lost, joined by one space."""
    own = slice(words.first[row], words.first[row + 1])
    return b" ".join([data[a:b] for a, b in zip(words.start[own][~lost].tolist(), words.end[own][~lost].tolist(), strict=True)])


def removed_spans(docs: DataFrame, block: int = 7, window: int = 13, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept, removed``: the text without repeated words (with ``digest`` its sha256), and their ranges ``[from, to)`` in words."""
    if window < 2 * block - 1:
        raise ValueError("A window of fewer than 2 * block - 1 words may hold no block.")
    docs = id_and_text(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(size, 4 * BUCKET_BYTES, 4)
    by_doc = written(anchors(docs, block))
    result = ["doc_id", "n_words", "n_removed", "kept", "removed"]
    spans = pa.list_(pa.list_(pa.int64()))

    def kept(text: bytes) -> str:
        return hashlib.sha256(text).hexdigest() if digest else text.decode()

    def candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(part["text"])
            words.block_windows = words.windows(block)
            data, ids = words.data.tobytes(), part["doc_id"].to_pylist()
            # A name for the slice from what it holds; two slices of one name would only be finished together.
            number = int.from_bytes(hashlib.blake2b(repr((ids, len(data))).encode(), digest_size=8).digest(), "little", signed=True)
            hits = part["anchors"].to_pylist()
            opened = [h is not None and len(anchored_windows(words, i, long(np.frombuffer(h, "u1")), block, window)) > 0 for i, h in enumerate(hits)]
            done = [None if o else kept(_cut(words, i, np.zeros(words.count[i], bool), data)) for i, o in enumerate(opened)]
            texts = [t if o else None for t, o in zip(part["text"].to_pylist(), opened, strict=True)]
            hits = [h if o else None for h, o in zip(hits, opened, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(part.num_rows, number)), part["doc_id"], pa.array(opened, pa.bool_()), pa.array(texts, pa.string()), pa.array(words.count, pa.int64()), pa.array(done, pa.string()), pa.array(hits, pa.binary())],
                ["slice", "doc_id", "open", "text", "n_words", "kept", "anchors"],
            )

    stage = docs.join(by_doc, "doc_id", "left").mapInArrow(candidates, "slice bigint, doc_id bigint, open boolean, text string, n_words bigint, kept string, anchors binary")
    stage = written(stage.coalesce(parts_for(docs.count(), TABLE_ROWS)))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each distinct window around an anchor in a slice its least and greatest document."""
        for part in slices(batches):
            begins, lengths = runs(part["slice"].to_numpy())
            for begin, length in zip(begins.tolist(), lengths.tolist(), strict=True):
                rows = part.slice(begin, length)
                words = Words(rows["text"])
                words.block_windows = words.windows(block)
                at, one = words.windows(window)
                two = words.windows(window, second=True)[1].astype("<u4")
                firsts, ids = np.searchsorted(at, words.first), rows["doc_id"].to_numpy()
                own = [firsts[i] + anchored_windows(words, i, long(np.frombuffer(h, "u1")), block, window) for i, h in enumerate(rows["anchors"].to_pylist())]
                owners = np.repeat(ids, [len(x) for x in own])
                own = np.concatenate(own)
                order = np.lexsort((owners, two[own], one[own]))
                a, b, owners = one[own][order], two[own][order], owners[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                starts = np.flatnonzero(new)
                a, b, least, most = a[starts], b[starts], owners[starts], owners[np.append(starts[1:], len(owners)) - 1]
                order = np.lexsort((most, least))  # equal numbers side by side take little room
                a, b, least, most = a[order], b[order], least[order], most[order]
                sent = packets(((a >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64), {"one": a, "two": b, "least": least, "most": most})
                yield pa.RecordBatch.from_arrays([pa.array(np.full(sent.num_rows, rows["slice"][0].as_py())), *sent.columns], ["slice", *sent.schema.names])

    def meet(table: pa.Table) -> pa.Table:
        """To each slice the windows of which it has other documents than the least of all, and that one."""
        a, b, least, most = raw(table["one"], "<u8"), raw(table["two"], "<u4"), raw(table["least"], "<i8"), raw(table["most"], "<i8")
        origin = np.repeat(table["slice"].to_numpy(), [len(v) // 8 for v in table["one"].to_pylist()])
        order = np.lexsort((least, b, a))
        a, b, least, most, origin = a[order], b[order], least[order], most[order], origin[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        begins = np.flatnonzero(new)
        first = np.repeat(least[begins], np.diff(np.append(begins, len(a))))
        tell = most > first
        first, a, b, origin = first[tell], a[tell], b[tell], origin[tell]
        order = np.lexsort((first, origin))
        first, a, b, origin = first[order], a[order], b[order], origin[order]
        begins, _ = runs(origin)
        bounds = np.append(begins, len(origin))
        return pa.table({"slice": origin[begins], "one": binaries(a, bounds), "two": binaries(b, bounds), "least": binaries(first, bounds)})

    sent = stage.filter("open").select("slice", "doc_id", "text", "anchors").mapInArrow(send, "slice bigint, bucket bigint, one binary, two binary, least binary, most binary")
    replies = sent.groupBy("bucket").applyInArrow(meet, "slice bigint, one binary, two binary, least binary")

    def finish(texts: pa.Table, told: pa.Table) -> pa.Table:
        one, two, least = raw(told["one"], "<u8"), raw(told["two"], "<u4"), raw(told["least"], "<i8")
        order = np.lexsort((two, one))
        one, two, least = one[order], two[order], least[order]
        # A pair of codes is looked up by its rank among the first ones and the second below it.
        rows = []
        for part in slices(texts.combine_chunks().to_batches()):
            words = Words(part["text"])
            data = words.data.tobytes()
            at, a = words.windows(window)
            b = words.windows(window, second=True)[1].astype("<u4")
            place = np.searchsorted(one, a)
            hit = np.zeros(len(a), bool)
            owner = part["doc_id"].to_numpy()[words.doc[at]]
            live = np.flatnonzero(place < len(one))
            while len(live):
                live = live[one[place[live]] == a[live]]
                same = two[place[live]] == b[live]
                hit[live[same]] = least[place[live[same]]] < owner[live[same]]
                live = live[~same]
                place[live] += 1
                live = live[place[live] < len(one)]
            firsts = np.searchsorted(at, words.first)
            for i, doc_id in enumerate(part["doc_id"].to_pylist()):
                n = int(words.count[i])
                change = np.zeros(n + 1, np.int64)
                starts = np.flatnonzero(hit[firsts[i] : firsts[i + 1]])
                change[: len(change)] += np.bincount(starts, minlength=n + 1) - np.bincount(starts + window, minlength=n + 1)
                lost = np.cumsum(change)[:n] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], lost.astype(np.int8), [0]])))
                rows.append((doc_id, n, int(lost.sum()), kept(_cut(words, i, lost, data)), edges.reshape(-1, 2).tolist()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), spans]
        return pa.table({c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate(zip(result, kinds, strict=True))})

    opened = stage.filter("open").select("slice", "doc_id", "text").groupBy("slice")
    cut = opened.cogroup(replies.groupBy("slice")).applyInArrow(finish, "doc_id bigint, n_words bigint, n_removed bigint, kept string, removed array<array<bigint>>")
    none = F.array().cast("array<array<bigint>>")
    return stage.filter("NOT open").select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept", none.alias("removed")).union(cut.select(*result))
