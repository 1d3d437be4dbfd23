"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers (in digits or words), their units and names become typed placeholders, case and punctuation go. Whether a
capital at the beginning of a sentence is a name is not known: it may stand for another one there. A document's
windows of placeholders and words are joined by hash with those of the benchmark, each name both as a placeholder and
as its word, so a copy is found in any case and punctuation; around a hit the two are aligned
and the longest run of fitting words counts whose slots are filled consistently: one value of the benchmark stands
for one value of the document and the other way round (the latter only if fewer than half of the words are the same).
A clash of two slots ends a run, and the words behind the earlier of them begin the next. So a question with other
numbers and names is found, and a chance template is not.

Benchmark windows begin at every word, document windows only at every ``width``-th: a run of ``2 width - 1`` words
holds one of them wherever it begins.

An item of fewer than ``shortest`` words has no template worth its name: its words are looked for as they are, all of
them in a row, at the bounds of words. Letters of scripts without blanks are words of their own if the benchmark has any.

Cases: a NULL or empty text is clean, an item without words is nowhere; repeated rows have equal results; rows without an id are judged too; of several items the smallest id is named; an
empty table gives no rows and an empty benchmark finds nothing; very long texts are searched whole; further columns
are not looked at.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import let
from .common import parts_for, row_key, written

#: A run of this many template words is a leak; of a shorter item, all its words.
RUN = 13
#: Items of fewer words are looked for word by word.
SHORTEST = 5
#: Words of a window at most; it has up to 2 to this power codes, if all its words are names.
WIDEST = 7
#: Benchmark windows that are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Documents of one file of the written tables.
TABLE_ROWS = 50_000

# Units of measure and money that follow a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl dl l ms s sec min h hr hrs kb mb gb tb hz khz mhz ghz w kw mw v a c f k pa bar "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters inch inches foot feet yard yards mile miles "
    "gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros usd eur gbp percent degree degrees"
).split()
# Numbers in words, joined without blanks; articles of other languages are none.
NUMBERS = {w: str(n) for n, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
LARGE = "hundred thousand million billion".split()
OTHER_NUMBERS = (
    "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante "
    "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend "
    "dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa"
).split()
# Scripts that write no blanks between words (Thai, Lao, Burmese, Khmer, kana, Han).
UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]"
_MARK = "\x01"
_UPPER, _LOWER = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_PUNCTUATION = "[!-/:-@\\[-`{-~¡-¿×÷‐-‧‰-⁞]+"
_SIGNS = "".join(c for c in map(chr, range(0x2060)) if re.match(_PUNCTUATION, c))


def _tree(words: list[str]) -> str:
    """A pattern of any of the words, by their letters: a text is compared with one branch and not with all."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words), reverse=True):
        heads.setdefault(w[:1], []).append(w[1:])
    ends = heads.pop("", None) is not None
    body = "|".join(c + (_tree(rest) if rest != [""] else "") for c, rest in heads.items())
    return (f"(?:{body})" + ("?" if ends else "")) if body else ""


def _numbers() -> str:
    """Digits, or a number in words, with its hundreds and so on; groups hold the parts without what lies between them."""
    gap, end = r"[\s-]+", r"(?![\p{L}\d])"
    ones, tens, large = _tree(list(NUMBERS)[1:10]), _tree(TENS), _tree(LARGE)
    words = rf"(?:({tens}){gap}({ones}){end}|({_tree([*NUMBERS, *TENS, *OTHER_NUMBERS])}){end})"
    rest = rf"(?:{gap}({large}){end}(?:{gap}(?:and{gap})?{words})?)?"
    # The letters that can begin a match are looked at first: that is cheaper than to look behind.
    first = "".join(sorted({w[0] for w in (*NUMBERS, *TENS, *OTHER_NUMBERS)}))
    return rf"(?=[\d\x01{first}])(?<![\d\x01\p{{L}}])(?:\x01[pq])?(?:(\d[\d.,:]*\d|\d)|{words}){rest}{rest}"


def marked(text: Column) -> Column:
    """The text without case and punctuation, words between blanks, with slots as ``\\x01`` and a letter before their value.

    n is a number, u its unit, p a name within a sentence, q another word with a capital.
    """
    # A capital in the midst of a sentence: after a small letter or a comma, and one space.
    named = F.regexp_replace(text, f"(?=[{_UPPER}][{_LOWER}])(?<=[{_LOWER},;] )", _MARK + "P")
    capitals = F.lower(F.regexp_replace(named, rf"(?=[\p{{Lu}}{_PUNCTUATION[1:-2]}])(?<!\S)({_PUNCTUATION[:-1]}*+)(?=\p{{Lu}}\p{{Ll}})", f"$1{_MARK}Q"))
    numbers = F.regexp_replace(capitals, _numbers(), f" {_MARK}n{''.join(f'${k}' for k in range(1, 13))}\x02 ")
    units = F.regexp_replace(numbers, rf"\x02\s*({'|'.join(sorted(UNITS, key=len, reverse=True))}|%|€|\$|£)(?![\p{{L}}\d])", f" {_MARK}u$1")
    # White space becomes a blank, punctuation goes.
    return F.translate(units, "\t\n\x0b\f\r\x02" + _SIGNS, " " * 5)


def _split(words: Column) -> Column:
    """What stands between blanks, however many these are."""
    return F.array_remove(F.split(words, " "), "")


def surfaces(text: Column) -> Column:
    """The words with their slots' values."""
    return _split(marked(text))


def windows(rows: DataFrame, words: str, width: int, step: int) -> DataFrame:
    """The rows with ``at`` and ``code`` of each window that begins at every ``step``-th of the surfaces in the column ``words``, in its place.

    Numbers and units are placeholders. A window has a code for each choice of names that stand as placeholders: whichever of two windows' names are
    the same word and whichever are other names, written in the same case or not, they have one code in common.
    A code joins the hashes of its words at their places by exclusive or, so a choice changes it by the choice's own share.
    """
    others = [F.col(f"`{c}`") for c in rows.columns if c != words]
    all_ = F.col(f"`{words}`")
    last = F.floor((F.size(all_) - width) / step).cast("int")
    at = F.when(F.size(all_) >= width, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    # A window is a row, so that its words are hashed by compiled code and not within a lambda function.
    cut = rows.select(*others, F.inline(F.transform(at, lambda i: F.struct((i * step).alias("at"), F.slice(all_, i * step + 1, width).alias("own")))))

    none = F.lit(0).cast("bigint")
    plain, turns = [], []
    for place in map(F.lit, range(width)):
        word = F.get("own", place)
        mark = F.substring(word, 1, 2)
        named = mark.isin(_MARK + "p", _MARK + "q")
        plain.append(F.xxhash64(F.when(named, _value(word)).when(mark.isin(_MARK + "n", _MARK + "u"), mark).otherwise(word), place))
        turns.append(F.when(named, plain[-1].bitwiseXOR(F.xxhash64(F.lit(_MARK + "p"), place))).otherwise(none))
    cut = cut.select(*others, "at", functools.reduce(Column.bitwiseXOR, plain).alias("code"), F.array_remove(F.array(*turns), none).alias("turns"))

    chosen = F.aggregate("turns", F.array("code"), lambda found, turn: F.concat(found, F.transform(found, lambda code: code.bitwiseXOR(turn))))
    return cut.select(*others, "at", F.explode(F.when(F.size("turns") == 0, F.array("code")).otherwise(chosen)).alias("code"))


def _value(word: Column) -> Column:
    """The word without the mark of a name, so that a name equals its copy in another case."""
    return F.replace(F.replace(word, F.lit(_MARK + "p")), F.lit(_MARK + "q"))


def _number(value: Column) -> Column:
    """A number in one word as digits."""
    digits = F.create_map(*[F.lit(x) for w, n in NUMBERS.items() for x in (f"{_MARK}n{w}", f"{_MARK}n{n}")])
    return F.coalesce(F.element_at(digits, value), value)


def _aligned(doc: Column, item: Column, shift: Column, need: Column) -> Column:
    """The longest accepted run of fitting words: ``struct<length, verbatim>``, of length 0 if none has ``need`` words.

    In a run one value of the item stands for one value of the document. It is accepted if the other way round holds
    too and names are names on both sides, or if at least half of some ``need`` words in a row are the same on both sides. Behind a clash the run goes on
    from the word after the earlier of the two slots, so the longest run without a clash is found. A changed slot that
    clashes with one outside the run is no evidence and not counted.
    """
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(doc) - shift)
    places = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<int>"))

    def pair(i: Column) -> Column:
        def judged(w: Column) -> Column:
            def kind(side: str, kinds: str) -> Column:
                return F.substring(w[side], 1, 2).isin([_MARK + k for k in kinds])

            same, alike = _number(_value(w["a"])) == _number(_value(w["b"])), F.substring(w["a"], 1, 2) == F.substring(w["b"], 1, 2)
            sure = alike & kind("a", "nup")
            # Case may have gone on one side, so a name stands for any one word there.
            slot = sure | (kind("a", "p") & ~kind("b", "nu")) | (kind("b", "p") & ~kind("a", "nu")) | (kind("a", "q") & kind("b", "q"))
            return F.struct(_number(_value(w["a"])).alias("a"), _number(_value(w["b"])).alias("b"), same.alias("same"), slot.alias("slot"), (same | slot).alias("fits"), (same | sure).alias("sure"))

        return let(F.struct(F.get(item, i).alias("a"), F.get(doc, i + shift).alias("b")), judged)

    def bounds(pairs: Column) -> Column:
        gaps = F.filter(F.transform(pairs, lambda p, i: F.when(~p["fits"], i)), lambda i: i.isNotNull())
        slots = F.filter(F.transform(pairs, lambda p, i: F.struct(p["a"].alias("a"), p["b"].alias("b"), p["same"].alias("same"), p["slot"].alias("slot"), i.alias("i"))), lambda p: p["slot"])
        slots = F.transform(slots, lambda p: p.withField("part", F.size(F.filter(gaps, lambda g: g < p["i"]))))

        def marked_pairs(slots: Column) -> Column:
            def bound(p: Column, i: Column) -> Column:
                def last(clash) -> Column:
                    return F.coalesce(F.array_max(F.transform(F.filter(slots, lambda q: (q["i"] < i) & clash(q)), lambda q: q["i"])), F.lit(-1))

                one = F.when(~p["fits"], i).when(p["slot"], last(lambda q: (q["a"] == p["a"]) & (q["b"] != p["b"]))).otherwise(-1)
                both = F.when(~p["sure"], i).when(p["slot"], last(lambda q: (q["a"] != p["a"]) & (q["b"] == p["b"]))).otherwise(-1)
                return F.struct(one.alias("one"), F.greatest(one, both).alias("both"), p["same"].alias("same"), i.alias("i"))

            def astray(clash) -> Column:
                found = F.filter(slots, lambda p: ~p["same"] & F.exists(slots, lambda q: (q["part"] == p["part"]) & clash(p, q)))
                return F.transform(found, lambda p: p["i"])

            one = astray(lambda p, q: (q["a"] == p["a"]) & (q["b"] != p["b"]))
            both = astray(lambda p, q: (q["a"] == p["a"]) != (q["b"] == p["b"]))
            return F.struct(F.transform(pairs, bound).alias("marks"), one.alias("one"), both.alias("both"))

        return let(slots, marked_pairs)

    def longest(known: Column) -> Column:
        marks, zero = known["marks"], F.lit(0)
        start = F.struct(zero.alias("one"), zero.alias("both"), zero.alias("same"), zero.alias("length"), F.lit(False).alias("verbatim"))

        def counted(m: Column, first: Column, astray: Column) -> Column:
            n = m["i"] + 1 - first
            return F.when(n >= need, n - F.size(F.filter(astray, lambda i: (i >= first) & (i <= m["i"])))).otherwise(0)

        def step(state: Column, m: Column) -> Column:
            one, both = F.greatest(state["one"], m["one"] + 1), F.greatest(state["both"], m["both"] + 1)
            same = F.when(m["same"], state["same"]).otherwise(m["i"] + 1)
            strict, loose = counted(m, both, known["both"]), counted(m, one, known["one"])
            carried = 2 * F.size(F.filter(F.slice(marks, F.greatest(m["i"] + 2 - need, F.lit(1)), need), lambda q: q["same"])) >= need
            run = F.when((loose > strict) & (loose > state["length"]) & (loose >= need) & carried, F.struct(loose.alias("n"), one.alias("first")))
            run = run.otherwise(F.struct(F.when(strict >= need, strict).otherwise(0).alias("n"), both.alias("first")))

            def following(run: Column) -> Column:
                longer = run["n"] > state["length"]
                return F.struct(
                    one.alias("one"), both.alias("both"), same.alias("same"), F.when(longer, run["n"]).otherwise(state["length"]).alias("length"),
                    F.when(longer, same <= run["first"]).otherwise(state["verbatim"]).alias("verbatim"),
                )

            return let(run, following)

        return F.aggregate(marks, start, step, lambda s: F.struct(s["length"].alias("length"), s["verbatim"].alias("verbatim")))

    return let(let(F.transform(places, pair), bounds), longest)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))


def _short_hits(rows: DataFrame, items: DataFrame, lengths: list[int], words_of) -> DataFrame:
    """``row_key, item_id, matched_words, verbatim``: rows that hold all words of a short item in a row."""
    probes = written(items.select("item_id", F.col("item_words").alias("own"), F.xxhash64("item_words").alias("code")))

    def codes(words: Column) -> Column:
        def of(n: int) -> Column:
            at = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda i: F.xxhash64(F.slice(words, i + 1, n)))

        return F.array_distinct(F.concat(*[of(n) for n in lengths]))

    pieces = rows.select("row_key", F.explode(let(words_of(F.col("text")), codes)).alias("code"))
    small = probes.count() <= BROADCAST_ROWS
    hits = pieces.join(F.broadcast(probes) if small else probes, "code").select("row_key", "item_id", "own").distinct()
    texts = rows.select("row_key", "text").distinct()
    looked = hits.join(texts, "row_key").withColumn("words", F.explode(F.array(words_of(F.col("text")))))
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - F.size("own") + 1, F.lit(1)))
    held = F.exists(places, lambda i: F.slice(F.col("words"), i, F.size("own")) == F.col("own"))
    return looked.filter(held).select("row_key", "item_id", F.size("own").alias("matched_words"), F.lit(True).alias("verbatim"))


def _found(rows: DataFrame, benchmark: DataFrame, run: int, shortest: int, item_col: str, item_text: str) -> DataFrame:
    """``row_key, item_id, matched_words, verbatim`` of the rows with a leak, written."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("item_id"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("t"))
    if not items.filter(F.col("t").rlike(UNSPACED)).isEmpty():
        items = items.withColumn("t", F.regexp_replace("t", f"({UNSPACED})", " $1 "))
        rows = rows.withColumn("text", F.regexp_replace("text", f"({UNSPACED})", " $1 "))
    items = written(items.select("item_id", surfaces(F.col("t")).alias("item_words")).distinct())
    short = items.filter((F.size("item_words") > 0) & (F.size("item_words") < shortest))
    lengths = sorted(r[0] for r in short.select(F.size("item_words")).distinct().collect())  # fewer than `shortest`
    bare = lambda text: F.transform(surfaces(text), _value)  # noqa: E731  a name is its word, in any case
    brief = _short_hits(rows, short.withColumn("item_words", F.transform("item_words", _value)), lengths, bare) if lengths else None
    items = items.filter(F.size("item_words") >= shortest)
    least = items.agg(F.min(F.size("item_words"))).first()[0] or run
    width = min((min(run, least) + 1) // 2, WIDEST)
    probes = written(windows(items, "item_words", width, 1).withColumnRenamed("at", "item_at").distinct())

    # The words go through a generator of one row: each text is cut once, not once for every use.
    cut = rows.select("row_key", F.explode(F.array(surfaces(F.col("text")))).alias("words"))
    pieces = windows(cut, "words", width, width)
    small = probes.count() <= BROADCAST_ROWS
    hits = pieces.join(F.broadcast(probes) if small else probes, "code").select("row_key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    parts = parts_for(rows.count(), TABLE_ROWS)
    hits = written(hits.coalesce(parts))

    texts = rows.join(hits.select("row_key").distinct(), "row_key").select("row_key", "text").distinct()
    texts = texts.select("row_key", surfaces(F.col("text")).alias("words"))
    looked = hits.join(texts, "row_key").join(items.select("item_id", "item_words"), "item_id")
    need = F.least(F.lit(run), F.size("item_words"))
    looked = looked.select("row_key", "item_id", _aligned(F.col("words"), F.col("item_words"), F.col("shift"), need).alias("found"))
    found = looked.filter(F.col("found.length") > 0).select("row_key", "item_id", F.col("found.length").alias("matched_words"), F.col("found.verbatim").alias("verbatim"))
    found = found if brief is None else found.unionByName(brief)
    found = found.groupBy("row_key").agg(F.min("item_id").alias("item_id"), F.max("matched_words").alias("matched_words"), F.bool_or("verbatim").alias("verbatim"))
    return written(found.coalesce(parts))


def leaks(docs: DataFrame, benchmark: DataFrame, run: int = RUN, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, contaminated, item_id, matched_words, verbatim`` for each row."""
    rows = _rows(docs, id_col, text_col)
    found = _found(rows, benchmark, run, shortest, item_col, item_text)
    return rows.select("doc_id", "row_key").join(found, "row_key", "left").select(
        "doc_id", F.col("matched_words").isNotNull().alias("contaminated"), "item_id", F.coalesce("matched_words", F.lit(0)).alias("matched_words"), F.coalesce("verbatim", F.lit(False)).alias("verbatim")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, run: int = RUN, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    found = _found(_rows(docs, id_col, text_col), benchmark, run, shortest, "item_id", "text").select(F.col("row_key").alias("leak_key"))
    key = row_key(F.col(f"`{id_col}`").cast("bigint"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return docs.join(found, key == found["leak_key"], "left_anti")
