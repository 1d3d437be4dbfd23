"""Negative examples by sampling from corpus-wide value sets, without pairing documents with the set.

A corpus set (labels, entity names, predicates) is numbered once in a repeatable random order. Each document has a
permutation of these numbers of its own, ``step * i + first`` modulo a prime, which is computed and not stored. A
document that needs k values it does not have takes the first k in the order of its permutation, leaving out its own.
This is sampling without replacement, and k = all is no special case.

A small set is a literal array, so a document draws within its row: no join, no shuffle. Of a larger set only
(document, number) rows are made, about as many as are kept, and an equi join on the number fetches the values.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import NEGATIVE_RATIO, SEED
from ..functions.common import hash_mod, let, seeded_hash, str_array
from ..functions.prompts import relation_prompt
from ..session import durable
from .ranks import seeded_rank

# A corpus set is a literal only below both bounds; beyond them its numbers are joined by shuffle, which spreads
# evenly because numbers are dense and permutations random.
SMALL_VALUES = 20_000
SMALL_CHARS = 1_000_000


def prime_from(n: int) -> int:
    """The smallest prime number that is ``n`` or more."""
    p = max(n, 2)
    while any(p % d == 0 for d in range(2, int(p**0.5) + 1)):
        p += 1
    return p


@dataclass(frozen=True)
class CorpusIndex:
    """A set of ``size`` values, numbered from 0: a literal array in that order, or a frame ``position, value``."""

    size: int
    values: Column | None = None
    frame: DataFrame | None = None

    @property
    def modulus(self) -> int:
        return prime_from(self.size)

    def walk(self, key: Column, seed: int | str) -> Column:
        """``struct(step, first)`` of a document's permutation."""
        p = F.lit(self.modulus).cast("bigint")
        return F.struct((hash_mod(f"{seed}:step", p - 1, key) + 1).alias("step"), hash_mod(seed, p, key).alias("first"))

    def steps(self, take: Column, own: Column) -> Column:
        """How many steps surely hold ``take`` values: as many of them as values are ``own`` or beyond the set may be in vain."""
        wanted = take + F.size(own) + (self.modulus - self.size)
        return F.when(take > 0, F.least(wanted, F.lit(self.modulus).cast("bigint"))).otherwise(0).cast("bigint")

    def place(self, walk: Column, i: Column) -> Column:
        return (walk["step"] * i + walk["first"]) % self.modulus

    def draw(self, key: Column, own: Column, take: Column, seed: int | str) -> Column:
        """The values drawn, as an array; for a set that is a literal."""

        def drawn(w: Column) -> Column:
            places = F.transform(F.sequence(F.lit(0).cast("bigint"), w["n"] - 1), lambda i: self.place(w["walk"], i).cast("int"))
            found = F.array_compact(F.transform(places, lambda at: F.get(self.values, at)))
            return F.when(w["n"] > 0, F.slice(F.array_except(found, own), 1, w["take"])).otherwise(str_array([]))

        if self.size == 0:
            return str_array([])
        return let(F.struct(self.walk(key, seed).alias("walk"), self.steps(take, own).alias("n"), take.cast("int").alias("take")), drawn)


def corpus_indexes(facts: DataFrame, sets: Mapping[str, Column], seed: int | str = SEED) -> dict[str, CorpusIndex]:
    """Number the distinct values of several per-document arrays, each in random order, in one pass over ``facts``."""
    tagged = [
        F.transform(F.array_distinct(values), lambda v: F.struct(F.lit(name).alias("kind"), v.alias("value"))) for name, values in sets.items()
    ]
    kept = durable(facts.select(F.inline(F.concat(*tagged))).where(F.col("value").isNotNull()).distinct())
    stats = kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars")).collect()
    sizes = {r["kind"]: (r["n"], r["chars"]) for r in stats}
    small = [name for name, (n, chars) in sizes.items() if n <= SMALL_VALUES and chars <= SMALL_CHARS]
    # Within the bounds of each set: one job for all of them.
    rows = kept.where(F.col("kind").isin(small)).select("kind", "value", seeded_hash(seed, F.col("value")).alias("h")).collect() if small else []
    out = {}
    for name in sets:
        n = sizes.get(name, (0, 0))[0]
        if n and name not in small:
            out[name] = CorpusIndex(n, frame=durable(seeded_rank(kept.where(F.col("kind") == name).select("value"), "value", seed, "position")))
        else:
            ordered = [value for _, value in sorted((r["h"], r["value"]) for r in rows if r["kind"] == name)]
            out[name] = CorpusIndex(n, values=F.from_json(F.lit(json.dumps(ordered)), "array<string>"))  # folded to one literal
    return out


def sample_size(available: Column, positives: Column, ratio: int) -> Column:
    """How many negatives to keep: all when they are few enough, else ``ratio`` per positive."""
    if ratio == -1:
        return available.cast("bigint")
    few = (positives == 0) | (F.ceil(available / positives) <= ratio)
    return F.when(few, available).otherwise(positives * ratio).cast("bigint")


def drawn_values(docs: DataFrame, index: CorpusIndex, key: str, own: str, take: str, seed: int | str) -> DataFrame:
    """``docs`` with ``value``, a row for each of the first ``take`` corpus values that are not in the array ``own``."""
    if index.frame is None:
        return docs.withColumn("value", F.explode(index.draw(F.col(key), F.col(own), F.col(take), seed)))
    n = index.steps(F.col(take), F.col(own))
    walks = docs.withColumn("__walk", index.walk(F.col(key), seed)).withColumn("__step", F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1))))
    draws = walks.withColumn("position", index.place(F.col("__walk"), F.col("__step")))
    fetched = draws.join(index.frame, "position").where(~F.coalesce(F.array_contains(F.col(own), F.col("value")), F.lit(False)))
    order = F.row_number().over(Window.partitionBy(key).orderBy("__step"))
    return fetched.withColumn("__n", order).where(F.col("__n") <= F.col(take)).select(*docs.columns, "value")


def entity_negatives(
    facts: DataFrame, labels: CorpusIndex, key: str, ratio: int = NEGATIVE_RATIO, seed: int | str = SEED, own: str = "labels"
) -> DataFrame:
    """``key, prompt``: corpus labels the document does not have, sampled by ratio to its own labels."""
    available = F.lit(labels.size) - F.size(own)
    docs = facts.select(key, F.array_distinct(F.array_compact(own)).alias(own)).withColumn("__take", sample_size(available, F.size(own), ratio))
    return drawn_values(docs, labels, key, own, "__take", seed).select(key, F.col("value").alias("prompt"))


def full_relation_negatives(facts: DataFrame, predicates: CorpusIndex, key: str, lang: str = "ch") -> DataFrame:
    """``key, prompt``: every gold subject with every corpus predicate, unless that prompt is a positive."""
    if predicates.size == 0:
        return facts.select(key, F.lit(None).cast("string").alias("prompt")).where(F.lit(False))
    if predicates.frame is None:
        each = F.transform("subjects", lambda s: F.transform(predicates.values, lambda p: relation_prompt(s, p, lang)))
        absent = F.filter(F.flatten(each), lambda x: ~F.coalesce(F.array_contains("prompts", x), F.lit(False)))
        return facts.select(key, F.explode(absent).alias("prompt"))
    rows = facts.select(key, "prompts", F.explode("subjects").alias("__s")).withColumn(
        "position", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(predicates.size - 1).cast("bigint")))
    )
    prompts = rows.join(predicates.frame, "position").withColumn("prompt", relation_prompt(F.col("__s"), F.col("value"), lang))
    return prompts.where(~F.coalesce(F.array_contains("prompts", F.col("prompt")), F.lit(False))).select(key, "prompt")


def pool_sizes(n1: Column, n2: Column, n3: Column, positives: Column, ratio: int, offset: Column) -> Column:
    """How many prompts each of three pools gives: ``ARRAY<BIGINT>``.

    Each pool first gives up to a third of the ratio. What is then missing to ``ratio`` per positive comes
    from the left-overs of all pools, by evenly spaced picks over their concatenation from a random offset;
    ``offset(total)`` draws that offset.
    """
    third = ratio // 3
    sizes = F.array(n1.cast("bigint"), n2.cast("bigint"), n3.cast("bigint"))
    first = F.transform(sizes, lambda n: sample_size(n, positives, third if ratio != -1 else -1))

    def top_up(base: Column) -> Column:
        left = F.zip_with(sizes, base, lambda n, t: n - t)
        total = F.aggregate(left, F.lit(0).cast("bigint"), lambda a, x: a + x)
        given = F.aggregate(base, F.lit(0).cast("bigint"), lambda a, x: a + x)
        missing = F.greatest(positives * ratio - given, F.lit(0)).cast("bigint")

        def spread(s: Column) -> Column:
            picks = let(
                offset(s["total"]),
                lambda start: F.transform(
                    F.sequence(F.lit(0).cast("bigint"), s["missing"] - 1),
                    lambda j: F.pmod(start + F.floor(j * s["total"] / s["missing"]), s["total"]),
                ),
            )
            bounds = F.array(
                F.lit(0).cast("bigint"), F.get(s["left"], F.lit(0)), F.get(s["left"], F.lit(0)) + F.get(s["left"], F.lit(1)), s["total"]
            )
            chosen = let(
                F.struct(picks.alias("p"), bounds.alias("b")),
                lambda d: F.transform(
                    base,
                    lambda t, i: t + F.size(F.filter(d["p"], lambda p: (p >= F.get(d["b"], i)) & (p < F.get(d["b"], i + 1)))),
                ),
            )
            return (
                F.when((s["missing"] <= 0) | (s["total"] == 0), base)
                .when(s["missing"] >= s["total"], sizes)
                .otherwise(chosen)
            )

        return let(F.struct(left.alias("left"), total.alias("total"), missing.alias("missing")), spread)

    return let(first, top_up)


def train_relation_negatives(
    facts: DataFrame,
    names: CorpusIndex,
    labels: CorpusIndex,
    key: str,
    ratio: int = NEGATIVE_RATIO,
    lang: str = "ch",
    seed: int | str = SEED,
) -> DataFrame:
    """``key, pool, prompt`` from three pools.

    1. objects used as subjects; 2. corpus entity names that are no subject here, each with a random
    predicate of the document; 3. labels the document lacks, each with a random subject.
    """
    n1 = F.size("inverse")
    n2 = F.when(F.size("predicates") > 0, F.lit(names.size) - F.size("subjects")).otherwise(F.lit(0))
    n3 = F.when(F.size("subjects") > 0, F.lit(labels.size) - F.size("labels")).otherwise(F.lit(0))
    sized = facts.select(
        key, "inverse", "predicates", "subjects", "labels",
        pool_sizes(n1, n2, n3, F.size("prompts"), ratio, lambda total: hash_mod(f"{seed}:top", total, F.col(key))).alias("__t"),
    )

    def take(i: int) -> Column:
        return F.get(F.col("__t"), F.lit(i))

    shuffled = F.array_sort(
        F.transform("inverse", lambda p, i: F.struct(seeded_hash(seed, F.col(key), i).alias("h"), i.alias("i"), p.alias("p")))
    )
    pool1 = F.transform(F.slice(shuffled, 1, take(0).cast("int")), lambda x: F.struct(F.lit(1).alias("pool"), x["p"].alias("prompt")))

    def random_of(array: str, value: Column) -> Column:
        return F.get(F.col(array), hash_mod(f"{seed}:pick", F.size(array), F.col(key), value).cast("int"))

    def name_prompt(value: Column) -> Column:
        return relation_prompt(value, random_of("predicates", value), lang)

    def label_prompt(value: Column) -> Column:
        return relation_prompt(random_of("subjects", value), value, lang)

    rows = sized.select(key, "predicates", "subjects", "labels", "__t", pool1.alias("__pool1"))
    pools, found = [F.col("__pool1")], []
    for number, index, own, prompt in ((2, names, "subjects", name_prompt), (3, labels, "labels", label_prompt)):
        if index.frame is None:
            drawn = index.draw(F.col(key), F.col(own), take(number - 1), seed)
            pools.append(_tagged(drawn, number, prompt))
        else:
            drawn = drawn_values(rows.select(key, "predicates", "subjects", "labels", take(number - 1).alias("__take")), index, key, own, "__take", seed)
            found.append(drawn.select(key, F.lit(number).alias("pool"), prompt(F.col("value")).alias("prompt")))
    # All pools that are drawn in the row come from one pass.
    out = rows.select(key, F.inline(F.concat(*pools)))
    for drawn in found:
        out = out.unionByName(drawn)
    return out


def _tagged(drawn: Column, pool: int, prompt) -> Column:
    return F.transform(drawn, lambda v: F.struct(F.lit(pool).alias("pool"), prompt(v).alias("prompt")))
