"""N-gram Jaccard join by an R-tree over count vectors.

A document is its set of distinct word shingles. Shingles are hashed into groups; how many fall into each group is
the document's point. The overlap of two sets is at most the sum of the smaller coordinates of their points, and with
a tree's box in place of a point, the sum of the smaller of coordinate and upper bound: what cannot reach the
overlap that the threshold asks for is left out, the rest is verified on the whole sets.

Points of unlike texts of one length lie close together, so one tree over a corpus would be visited almost whole by
every query. Trees are therefore built within blocks that no linked pair can miss: two sets at the threshold share a
shingle among the first ``n - ceil(t n) + 1`` of each in any common order. The order puts shingles that are frequent
anywhere last. A block's pairs with its least member are verified first; blocks that are then one component need no
more, so a family of near copies costs as many pairs as it has members and is not expanded.

Equal sets are one node. Cases: no words or a NULL text: an empty set, linked with nothing; fewer words than a shingle
has: the sequence as one shingle; rows without an id take part and are never a component's id; repeated rows are
equal sets; an empty table gives no rows; very long texts are taken whole; further columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binaries, id_and_text, row_key, packets, parts_for, raw, runs, slices, text_steps, written
from .components import components
from .words import U64, Words, mix

#: Prefix entries that one task takes, and members of a block that one tree holds; a larger block is cut into pairs of parts.
TASK_ENTRIES, TREE_MEMBERS = 400_000, 2048
#: Documents of one file of the written tables.
TABLE_ROWS = 20_000
#: Boxes under one node of a tree.
FANOUT = 16
#: At most so many frequent shingles are put last in the order: the most frequent. The order is only a matter of speed.
FREQUENT = 50_000
#: So many of its blocks each set knows when all pairs are listed; no block's code is NO_BLOCK or the number before it.
FIRST_BLOCKS, NO_BLOCK = 4, (1 << 63) - 1
_SKETCH = "doc_id bigint, row_key bigint, node bigint, n int, prefix binary, point binary"


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted fingerprints of each text's distinct shingles."""
    for texts in text_steps(column):
        words = Words(texts, lower=True)
        at, codes = words.windows(size)
        first = np.searchsorted(words.doc[at] if len(at) else at, np.arange(len(words.count) + 1))
        for i, n in enumerate(words.count.tolist()):
            if n >= size:
                yield np.unique(codes[first[i] : first[i + 1]])
            elif n:
                own, k = words.code[words.first[i] : words.first[i + 1]], U64(0)
                for c in own.tolist():
                    k = mix(np.array([k], U64) * U64(31) + U64(c))[0]
                yield np.array([k], U64)
            else:
                yield np.zeros(0, U64)


def dimensions(n: int) -> int:
    """Groups for a set of ``n``: a power of two, one or two shingles each, so that what two sets do not share rarely adds to their bound."""
    return 1 << max(4, n.bit_length() - 1)


def point_of(codes: np.ndarray) -> np.ndarray:
    d = dimensions(len(codes))
    return np.bincount((codes & U64(d - 1)).astype(np.int64), minlength=d).astype("<u2")


def packed(point: np.ndarray) -> bytes:
    """A point in few bytes; nearly all its coordinates are small."""
    small = not len(point) or point.max() < 256
    return (b"1" if small else b"2") + zlib.compress(point.astype("u1" if small else "<u2").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), "u1" if data[:1] == b"1" else "<u2")


def folded(point: np.ndarray, d: int) -> np.ndarray:
    """The point over fewer groups."""
    return point.reshape(-1, d).sum(0, dtype=np.int32) if len(point) > d else point


def may_link(x: np.ndarray, nx: int, y: np.ndarray, ny: int, share: int) -> bool:
    """Whether two points allow the overlap, at the finest groups that both have."""
    d = min(len(x), len(y))
    return (100 + share) * int(np.minimum(folded(x, d), folded(y, d)).sum(dtype=np.int64)) >= share * (nx + ny)


def node_of(codes: np.ndarray) -> int:
    """The set's name: sums over its members under two mixings, so it does not depend on an order."""
    one, two = codes.sum(dtype=U64), mix(codes ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)
    return int(mix(np.array([one ^ mix(np.array([two + U64(len(codes))], U64))[0]], U64)).view(np.int64)[0])


def frequent_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Fingerprints of shingles that are frequent within some slice of the corpus, the rarest first.

    Every text is counted. A slice passes on what recurs in it beyond one text in 200, so what is sent stays small.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            codes = np.sort(np.concatenate([*shingle_sets(part.column("text"), size), np.zeros(0, U64)]))
            begins, lengths = runs(codes)
            many = lengths >= max(8, part.num_rows // 200)
            yield pa.RecordBatch.from_arrays([pa.array(codes[begins[many]].view(np.int64)), pa.array(lengths[many], pa.int64())], ["code", "n"])

    found = docs.select("text").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "code").limit(FREQUENT).toPandas()
    return top["code"].to_numpy(np.int64).view(U64)[::-1].copy()


def sketches(docs: DataFrame, size: int, share: int, frequent: np.ndarray) -> DataFrame:
    """For each row its node, set size, prefix and point."""
    names = np.argsort(frequent)
    ordered = frequent[names]
    frequent_of = docs.sparkSession.sparkContext.broadcast((ordered, names + 1))

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent_of.value
        for part in slices(batches):
            nodes, sizes, prefixes, points = [], [], [], []
            for codes in shingle_sets(part.column("text"), size):
                n = len(codes)
                order = codes
                if n and len(known):
                    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                    late = np.where(known[at] == codes, rank[at], 0)
                    if late.any():
                        order = codes[np.argsort(late, kind="stable")]
                nodes.append(node_of(codes))
                sizes.append(n)
                prefixes.append(order[: n + (-share * n) // 100 + 1 if n else 0].tobytes())
                points.append(packed(point_of(codes)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row_key"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.binary()), pa.array(points, pa.binary())],
                ["doc_id", "row_key", "node", "n", "prefix", "point"],
            )

    return docs.mapInArrow(sketch, _SKETCH)


def block_members(rows: DataFrame) -> DataFrame:
    """``code, node, members``: the nodes of each block with at least two. Equal sets are one before the exchange, as far as a batch shows them."""
    buckets = parts_for(rows.agg(F.sum(F.octet_length("prefix")) / 8).first()[0] or 0, TASK_ENTRIES, 4)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once = np.unique(batch.column("node").to_numpy(), return_index=True)[1]
            batch = batch.take(pa.array(once))
            prefix = batch.column("prefix")
            codes = raw(prefix, "<u8")
            counts = np.array([len(x) // 8 for x in prefix.to_pylist()])
            nodes = np.repeat(batch.column("node").to_numpy(), counts)
            # Multiplying the upper half deals out evenly whatever the lower bits are.
            bucket = ((codes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            yield packets(bucket, {"codes": codes, "nodes": nodes})

    def gather(table: pa.Table) -> pa.Table:
        codes, nodes = raw(table["codes"], "<u8"), raw(table["nodes"], "<i8")
        order = np.lexsort((nodes, codes))
        codes, nodes = codes[order], nodes[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (nodes[1:] != nodes[:-1])
        codes, nodes = codes[new], nodes[new]
        begins, lengths = runs(codes)
        many = np.repeat(lengths > 1, lengths)
        return pa.table({"code": codes[many].view(np.int64), "node": nodes[many], "members": np.repeat(lengths, lengths)[many]})

    dealt = rows.filter("n > 0").select("node", "prefix").mapInArrow(deal, "bucket bigint, codes binary, nodes binary")
    return dealt.groupBy("bucket").applyInArrow(gather, "code bigint, node bigint, members bigint")


class CountTree:
    """An R-tree over points, packed from the leaves: a node has the upper bounds of its coordinates and the least size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points.argmax(1), sizes))
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            high, low = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.maximum.reduceat(high, at), np.minimum.reduceat(low, at)))

    def near(self, point: np.ndarray, size: int, share: int) -> np.ndarray:
        """Members whose overlap with ``point`` may be enough; sizes must be within the threshold of each other."""
        at = np.arange(len(self.levels[-1][1]))
        for k in range(len(self.levels) - 1, -1, -1):
            high, low = self.levels[k]
            bound = np.minimum(high[at], point).sum(1)
            # 100 o >= share (a + b - o)
            at = at[(100 + share) * bound >= share * (size + np.maximum(low[at], -(-share * size // 100)))]
            if k:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[k - 1][1])]
        return self.order[at]


def block_pairs(members: DataFrame, sets: DataFrame, labels: DataFrame, share: int, nearest: bool) -> DataFrame:
    """``a, b``: pairs within a block, of different labels, that the points allow; from blocks of three and more.

    With ``nearest`` each member has only the pair with the highest bound. Without it every pair comes; two sets that
    have one of their first ``FIRST_BLOCKS`` blocks in common are a pair there and not in later blocks.
    """
    named = members.filter("members > 2").join(labels, "node", "left").select("code", "node", "members", F.coalesce("root", "node").alias("label"))
    mixed = named.groupBy("code").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("code")
    sized = named.join(mixed, "code").join(sets.select("node", "n"), "node")
    if nearest:
        sized = sized.withColumn("firsts", F.array().cast("array<bigint>"))
    else:
        own = Window.partitionBy("node").orderBy("code").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        sized = sized.withColumn("firsts", F.array(*[F.coalesce(F.nth_value("code", k).over(own), F.lit(NO_BLOCK)) for k in range(1, FIRST_BLOCKS + 1)]))
    # In a block of one tree, a member without another of its size, give or take the threshold, has no partner.
    small = F.col("members") <= TREE_MEMBERS
    by_size = Window.partitionBy("code", F.when(small, 0).otherwise(F.xxhash64("node"))).orderBy("n", "node")
    sized = sized.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
    close = (100 * F.col("below") >= share * F.col("n")) | (100 * F.col("n") >= share * F.col("above"))
    rows = sized.filter(~small | F.coalesce(close, F.lit(False))).drop("below", "above").join(sets.select("node", "point"), "node")
    # A block beyond TREE_MEMBERS is cut into parts by a hash, and every two parts meet in a task of their own.
    cuts = F.ceil(F.col("members") / TREE_MEMBERS).cast("int")
    part = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    rows = rows.withColumn("cuts", cuts).withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    rows = rows.select("code", "node", "label", "n", "point", "firsts", "part", other).select(
        "code", "node", "label", "n", "point", "firsts", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    tasks = parts_for(rows.count(), 50_000, 4)
    spread = rows.repartition(tasks, "code", "low", "high").sortWithinPartitions("code", "low", "high")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            node, label, n, part = (block[c].to_numpy() for c in ("node", "label", "n", "part"))
            values = [unpacked(p) for p in block["point"].to_pylist()]
            d = min(map(len, values))
            points = np.stack([folded(v, d) for v in values]).astype(np.int32)
            tree, one, two = CountTree(points, n), [], []
            code, firsts = block["code"][0].as_py(), block["firsts"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            across = block["low"][0].as_py() != block["high"][0].as_py()
            for i in range(len(node)):
                near = tree.near(points[i], int(n[i]), share)
                near = near[(node[near] < node[i]) & (label[near] != label[i])]
                if across:  # pairs within a part are found where the part meets itself
                    near = near[part[near] != part[i]]
                if len(near) and not nearest:
                    shared = firsts[near][:, :, None] == np.where(firsts[i] < code, firsts[i], NO_BLOCK - 1)
                    near = near[~shared.any((1, 2))]
                near = near[[may_link(values[i], int(n[i]), values[j], int(n[j]), share) for j in near]] if len(near) else near
                if nearest and len(near) > 1:
                    bound = np.minimum(points[near], points[i]).sum(1)
                    near = near[np.argmax(bound / (n[near] + n[i] - bound))][None]
                one.append(node[near])
                two.append(np.full(len(near), node[i]))
            return np.concatenate(one), np.concatenate(two)

        held: list[pa.RecordBatch] = []

        def key(batch: pa.RecordBatch, row: int) -> tuple:
            return tuple(batch.column(c)[row].as_py() for c in ("code", "low", "high"))

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                block = pa.Table.from_batches(held)
                a, b = pairs(block)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        last = None
        for batch in batches:
            named = [batch.column(c).to_numpy() for c in ("code", "low", "high")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in named], axis=0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                if b > a:
                    if key(batch, a) != last:
                        yield from flush()
                        last = key(batch, a)
                    held.append(batch.slice(a, b - a))
        yield from flush()

    return spread.mapInArrow(search, "a bigint, b bigint").distinct()


def allowed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs whose sizes and points allow the overlap."""
    slim = sets.select("node", "n", "point")
    left = slim.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    right = slim.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    near = (100 * F.least("na", "nb") >= share * F.greatest("na", "nb"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(batch["na"].to_pylist(), batch["nb"].to_pylist(), batch["pa"].to_pylist(), batch["pb"].to_pylist(), strict=True):
                keep.append(may_link(unpacked(x), na, unpacked(y), nb, share))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").filter(near).select("a", "b", "na", "nb", "pa", "pb").mapInArrow(check, "a bigint, b bigint")


def whole_sets(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``node, codes`` for the chosen ``node, row_key``, from the texts."""
    texts = docs.join(chosen, "row_key").select("node", "text")

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [(node, codes) for node, codes in zip(part["node"].to_pylist(), shingle_sets(part["text"], size), strict=True) if node_of(codes) == node]
            bounds = np.cumsum([0, *[len(c) for _, c in found]])
            codes = np.concatenate([*[c for _, c in found], np.zeros(0, U64)])
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), binaries(codes, bounds)], ["node", "codes"])

    return texts.mapInArrow(compute, "node bigint, codes binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, whole: DataFrame, share: int) -> DataFrame:
    """The pairs that are linked, from their whole sets."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["ca"].to_pylist(), batch["cb"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= share * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = whole.select(F.col("node").alias("a"), F.col("codes").alias("ca")), whole.select(F.col("node").alias("b"), F.col("codes").alias("cb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ca", "cb").mapInArrow(check, "a bigint, b bigint")


def _placed(docs: DataFrame, size: int, share: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, row_key, n_shingles, root`` for each row; ``root`` is NULL for an empty set."""
    docs = id_and_text(docs, id_col, text_col).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    rows = written(sketches(docs, size, share, frequent_shingles(docs, size)), small=True)
    parts = parts_for(rows.count(), TABLE_ROWS)
    members = written(block_members(rows))
    sets = rows.join(members.select("node").distinct(), "node").groupBy("node")
    sets = written(sets.agg(F.min("row_key").alias("row_key"), F.first("n").alias("n"), F.first("point").alias("point")).coalesce(parts))

    def linked(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        whole = written(whole_sets(docs, nodes.join(sets.select("node", "row_key"), "node"), size).coalesce(parts), small=True)
        return written(verified(pairs, whole, share).coalesce(parts), small=True)

    # First, each member with the least of its block.
    least = members.groupBy("code").agg(F.min("node").alias("b"))
    stars = members.join(least, "code").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    links = linked(written(allowed(stars, sets, share).coalesce(parts)))
    labels = components(links)
    # Then what can still link different components, from the trees: first the nearest, so that families come together
    # and need no more, then all that is left.
    tried = stars.select(F.col("b").alias("a"), F.col("a").alias("b"))
    for nearest in (True, False):
        pairs = written(block_pairs(members, sets, labels, share, nearest).join(tried, ["a", "b"], "left_anti").coalesce(parts))
        links, tried = links.union(linked(pairs)), tried.union(pairs)
        labels = components(links)
    placed = rows.join(labels, "node", "left")
    root = F.when(F.col("n") > 0, F.coalesce("root", "node"))
    return written(placed.select("doc_id", "row_key", F.col("n").cast("bigint").alias("n_shingles"), root.alias("root")).coalesce(parts))


def similar_groups(docs: DataFrame, size: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row: documents link when ``100 |A and B| >= share |A or B|``."""
    placed = _placed(docs, size, share, id_col, text_col)
    ids = placed.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = placed.join(ids, "root", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def without_similar(docs: DataFrame, size: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those of which a linked one with a smaller id stays; of equal rows all or none stay."""
    placed = _placed(docs, size, share, id_col, text_col).filter(F.col("root").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    first = placed.groupBy("root").agg(F.min(order)["row_key"].alias("stays"), F.count("*").alias("rows"))
    gone = placed.join(first.filter("rows > 1"), "root").filter("row_key <> stays").select(F.col("row_key").alias("gone_key")).distinct()
    key = row_key(F.col(f"`{id_col}`").cast("bigint"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return docs.join(gone, key == gone["gone_key"], "left_anti")
