"""Cutting long contents into pieces that fit a model, never through a span."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ERROR_SEQ_LEN, MAX_SEQ_LEN, PROMPT_OVERHEAD
from ..functions.common import let, running, slice_of, stable_sort_by, str_array
from ..functions.text import read_blocks, strip_text, stripped_prefix, text_blocks
from ..schemas import PLAIN_SPANS
from .validate import REASON, span_reason


def check_capacity(max_seq_len: int, prompts: list[str]) -> None:
    if any(max_seq_len <= len(p) + PROMPT_OVERHEAD for p in prompts):
        raise ValueError(ERROR_SEQ_LEN)


def chunk_starts(length: Column, capacity: Column, spans: Column) -> Column:
    """Where each chunk starts, for sorted spans no longer than ``capacity``.

    Of spans that overlap an earlier one may be cut through. For each span: whole chunks up to the one it begins in, then a cut at its start if it would be split.
    """

    def step(s: Column, x: Column) -> Column:
        whole = F.floor(F.greatest(x["start"] - s["at"], F.lit(0)) / capacity).cast("int")
        beyond = x["end"] > s["at"] + capacity
        moved = F.when(beyond, s["at"] + whole * capacity).otherwise(s["at"]).cast("int")
        steps = F.when(beyond & (whole > 0), F.sequence(s["at"] + capacity, moved, capacity)).otherwise(F.array().cast("array<int>"))
        cut = F.when(beyond & (x["end"] > moved + capacity), F.array(x["start"])).otherwise(F.array().cast("array<int>"))
        return F.struct(
            F.when(F.size(cut) > 0, x["start"]).otherwise(moved).cast("int").alias("at"),
            F.concat(s["out"], steps, cut).alias("out"),
        )

    state = F.struct(F.lit(0).alias("at"), F.array(F.lit(0)).alias("out"))

    def rest(s: Column) -> Column:
        more = F.when(s["at"] + capacity < length, F.sequence(s["at"] + capacity, length - 1, capacity)).otherwise(F.array().cast("array<int>"))
        return F.concat(s["out"], more)

    return F.when(length > 0, F.aggregate(spans, state, step, rest)).otherwise(F.array().cast("array<int>"))


def chunk_examples(
    df: DataFrame,
    max_seq_len: int = MAX_SEQ_LEN,
    content: str = "content",
    prompt: str = "prompt",
    spans: str = "result_list",
    strict: bool = True,
    order_spans: bool = True,
) -> DataFrame:
    """One row per chunk: ``chunk_no, chunk_start, content, result_list`` (offsets within the chunk).

    The content is stripped first and its spans move along. Spans may overlap as long as no cut goes through one.
    Rows that cannot be cut come back whole with a ``reject_reason``. With ``strict=False`` a content that fits is passed through unstripped, and spans
    that are too long, or begin in what was stripped, are dropped and listed in ``dropped_spans`` instead of rejecting the row.
    """
    capacity = (F.lit(max_seq_len - PROMPT_OVERHEAD) - F.length(F.col(prompt))).cast("int")
    original, kept = F.col(content), F.coalesce(F.col(spans), F.array()).cast(PLAIN_SPANS)
    if order_spans:
        kept = stable_sort_by(kept, "start")
    stripped = strip_text(original)
    passes = F.length(stripped) <= capacity if not strict else F.lit(False)

    df = (
        df.withColumn("__cap", capacity)
        .withColumn("__text", F.when(passes, original).otherwise(stripped))
        .withColumn("__shift", F.when(passes, F.lit(0)).otherwise(stripped_prefix(original)))
        .withColumn(
            "__spans",
            F.transform(
                kept,
                lambda s: F.struct(
                    s["text"].alias("text"), (s["start"] - F.col("__shift")).alias("start"), (s["end"] - F.col("__shift")).alias("end")
                ),
            ).cast(PLAIN_SPANS),
        )
    )
    if not strict:
        outside = lambda s: ~passes & ((s["start"] < 0) | (s["start"] >= F.length(F.col("__text"))))
        dropped = lambda s: (s["end"] - s["start"] > F.col("__cap")) | outside(s)
        df = df.withColumn("dropped_spans", F.filter(F.col("__spans"), dropped)).withColumn(
            "__spans", F.filter(F.col("__spans"), lambda s: ~dropped(s))
        )

    wrong = F.exists(F.col("__spans"), lambda s: slice_of(F.col("__text"), s["start"], s["end"]) != s["text"])
    if strict:
        reason = F.coalesce(span_reason(F.col("__spans"), F.col("__cap")), F.when(wrong, F.lit("slice differs from span text")))
    else:
        reason = span_reason(F.col("__spans"), F.col("__cap"))
    df = df.withColumn(REASON, reason)

    fits = F.length(F.col("__text")) <= F.col("__cap") if strict else passes

    # The reason travels with the piece, so that a filter on it is not pushed below the cutting and computed twice.
    no_reason = F.lit(None).cast("string")

    def cut(starts: Column) -> Column:
        def one(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.length(F.col("__text")))
            inside = F.filter(F.col("__spans"), lambda s: (s["start"] >= start) & (s["start"] < end))
            moved = F.transform(
                inside,
                lambda s: F.struct(s["text"].alias("text"), (s["start"] - start).alias("start"), (s["end"] - start).alias("end")),
            )
            return F.struct(
                i.cast("int").alias("chunk_no"), start.cast("int").alias("chunk_start"), end.cast("int").alias("chunk_end"),
                moved.cast(PLAIN_SPANS).alias("spans"), no_reason.alias("reason"),
            )

        def checked(pieces: Column) -> Column:
            through = F.exists(pieces, lambda p: F.exists(p["spans"], lambda s: s["end"] > p["chunk_end"] - p["chunk_start"]))
            return F.when(through, whole(F.lit("a cut goes through a span"))).otherwise(pieces)

        return let(F.transform(starts, one), checked)

    def whole(reason: Column) -> Column:
        return F.array(
            F.struct(
                F.lit(0).alias("chunk_no"), F.lit(0).alias("chunk_start"), F.length(F.col("__text")).cast("int").alias("chunk_end"),
                F.col("__spans").alias("spans"), reason.alias("reason"),
            )
        )

    nonempty = F.length("__text") > 0 if strict else F.lit(True)
    starts = F.when(fits & nonempty, F.array(F.lit(0))).otherwise(chunk_starts(F.length("__text"), F.col("__cap"), F.col("__spans")))
    plan = F.when(F.col(REASON).isNotNull(), whole(F.col(REASON))).otherwise(let(starts, cut))
    others = [c for c in df.columns if c not in {content, spans, "__cap", "__text", "__shift", "__spans", REASON, prompt}]
    return (
        df.withColumn("__blocks", text_blocks(F.col("__text")))
        .withColumn("__c", F.explode(plan))
        .select(
            *others,
            prompt,
            F.col("__c.chunk_no").alias("chunk_no"),
            F.col("__c.chunk_start").alias("chunk_start"),
            F.when(F.col("__c.reason").isNotNull(), F.col("__text"))
            .otherwise(read_blocks(F.col("__blocks"), F.col("__c.chunk_start"), F.col("__c.chunk_end")))
            .alias(content),
            F.col("__c.spans").alias(spans),
            F.col("__c.reason").alias(REASON),
        )
    )


# --- all prompts of a document at once ------------------------------------------------------------

LEGS = "struct<at:int,first:int>"


def cut_plan(length: Column, capacity: Column, spans: Column) -> Column:
    """``struct(starts, places)``: where chunks start, and the number of the chunk in which each span begins.

    ``spans`` are sorted by start, of equal starts the longest first, and none is longer than ``capacity``. Chunks
    follow each other every ``capacity`` characters from a cut on, and a span that would be split is a new cut. So a
    place is found by division from the last cut, and only cuts are listed: the work grows with spans and chunks.
    """

    def step(leg: Column, x: Column) -> Column:
        def place(no: Column) -> Column:
            cuts = x["end"] > leg["at"] + (no + 1) * capacity
            first = leg["first"] + no + 1
            after = F.struct(F.when(cuts, x["start"]).otherwise(leg["at"]).alias("at"), F.when(cuts, first).otherwise(leg["first"]).alias("first")).cast(LEGS)
            out = F.struct(F.when(cuts, first).otherwise(leg["first"] + no).alias("no"), F.when(cuts, x["start"]).alias("cut"))
            return F.struct(after.alias("state"), out.cast("struct<no:int,cut:int>").alias("out"))

        return let(F.floor((x["start"] - leg["at"]) / capacity).cast("int"), place)

    def planned(walk: Column) -> Column:
        cuts = F.concat(F.array(F.lit(0)), F.array_compact(F.transform(walk, lambda w: w["cut"])))

        def legs(c: Column) -> Column:
            return F.flatten(F.transform(c, lambda at, i: F.sequence(at, F.coalesce(F.get(c, i + 1), length) - 1, capacity)))

        return F.struct(let(cuts, legs).alias("starts"), F.transform(walk, lambda w: w["no"]).alias("places"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("first")).cast(LEGS)
    return let(running(spans, begin, step, "struct<no:int,cut:int>")["out"], planned)


_CHUNKS = f"array<struct<chunk_no:int,chunk_start:int,content:string,spans:{PLAIN_SPANS},reason:string>>"


def _plain(spans: Column, back: Column | int = 0) -> Column:
    """Spans as text and offsets, moved back; of equal starts in the order given."""
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["i"].alias("i"), s["end"].alias("end"), s["text"].alias("text"))))
    return F.transform(in_order, lambda s: F.struct(s["text"].alias("text"), (s["start"] - back).alias("start"), (s["end"] - back).alias("end"))).cast(PLAIN_SPANS)


def _chunk(no: Column, start: Column, content: Column, spans: Column, reason: Column | None = None) -> Column:
    reason = F.lit(None).cast("string") if reason is None else reason
    return F.struct(no.cast("int").alias("chunk_no"), start.cast("int").alias("chunk_start"), content.alias("content"), spans.alias("spans"), reason.alias("reason"))


def _pieces(d: Column, capacity: Column, spans: Column, rejects: bool) -> Column:
    """The chunks of one prompt, those with spans first; or the whole text with a reason, if a cut goes through a span.

    With ``rejects`` only the latter.
    """
    length, none = d["length"], F.array().cast(PLAIN_SPANS)

    def piece(no: Column, starts: Column, mine: Column | None = None) -> Column:
        start, end = F.get(starts, no), F.coalesce(F.get(starts, no + 1), length)
        return _chunk(no, start, read_blocks(d["blocks"], start, end), none if mine is None else _plain(mine, start))

    def with_plan(p: Column) -> Column:
        places, starts = p["places"], p["starts"]
        # Spans of a chunk are neighbours; a run begins where the chunk changes.
        heads = F.array_compact(F.transform(places, lambda no, i: F.when((i == 0) | (no != F.get(places, i - 1)), i)))

        def gathered(h: Column) -> Column:
            full = F.transform(h, lambda i, k: piece(F.get(places, i), starts, F.slice(spans, i + 1, F.coalesce(F.get(h, k + 1), F.size(places)) - i)))
            bare = F.array_except(F.sequence(F.lit(0), F.size(starts) - 1), places)
            return F.concat(full, F.transform(bare, lambda no: piece(no, starts)))

        through = F.exists(F.zip_with(spans, places, lambda s, no: s["end"] > F.coalesce(F.get(starts, no + 1), length)), lambda x: x)
        whole = _chunk(F.lit(0), F.lit(0), d["text"], _plain(spans), F.lit("a cut goes through a span"))
        return F.when(through, F.array(whole)).otherwise(F.array().cast(_CHUNKS) if rejects else let(heads, gathered))

    # Without spans the chunks follow each other from the beginning on.
    plain = let(F.sequence(F.lit(0), length - 1, capacity), lambda starts: F.transform(starts, lambda _, no: piece(no, starts)))
    cut = F.when(F.size(spans) == 0, F.array().cast(_CHUNKS) if rejects else plain).otherwise(let(cut_plan(length, capacity, spans), with_plan))
    return F.when(length > 0, cut).otherwise(F.array().cast(_CHUNKS))


def _of_prompt(d: Column, prompt: Column, max_seq_len: int, strict: bool, rejects: bool) -> Column:
    """The chunks of one document for one prompt, as ``struct(prompt, c, dropped)``."""

    def with_capacity(cap: Column) -> Column:
        passes = F.lit(False) if strict else d["length"] <= cap
        moved = lambda shift: F.transform(
            F.filter(d["spans"], lambda s: s["prompt"] == prompt),
            lambda s: F.struct(s["text"].alias("text"), (s["start"] - shift).alias("start"), (-s["back"] - shift).alias("end"), s["i"].alias("i")),
        )
        if strict:
            return let(F.struct(moved(d["shift"]).alias("kept"), F.array().cast(PLAIN_SPANS).alias("dropped")), lambda x: rows(x, cap, passes))
        dropped = lambda s: (s["end"] - s["start"] > cap) | (~passes & ((s["start"] < 0) | (s["start"] >= d["length"])))
        parted = lambda o: F.struct(F.filter(o, lambda s: ~dropped(s)).alias("kept"), _plain(F.filter(o, dropped)).alias("dropped"))
        return let(let(let(F.when(passes, 0).otherwise(d["shift"]), moved), parted), lambda x: rows(x, cap, passes))

    def rows(x: Column, cap: Column, passes: Column) -> Column:
        spans = x["kept"]
        # At most one check fails first; the order is that of the reasons.
        wrong = lambda s: F.when(s["start"] > s["end"], 1).when(s["end"] - s["start"] > cap, 2)
        if strict:
            found = lambda s: F.when(s["start"] < 0, slice_of(d["text"], s["start"], s["end"])).otherwise(read_blocks(d["blocks"], s["start"], s["end"]))
            faults = F.transform(spans, lambda s: F.coalesce(wrong(s), F.when(found(s) != s["text"], 3)))
        else:
            faults = F.transform(spans, wrong)
        fault = F.when(cap <= 0, 0).otherwise(F.array_min(faults))
        fits = passes if not strict else (d["length"] <= cap) & (d["length"] > 0)

        def out(reason: Column) -> Column:
            body = d["text"] if strict else F.when(passes, d["whole"]).otherwise(d["text"])
            whole = F.array(_chunk(F.lit(0), F.lit(0), body, _plain(spans), reason))
            # An empty span at the end lies in no chunk.
            pieces = _pieces(d, cap, F.filter(spans, lambda s: s["start"] < d["length"]), rejects)
            if rejects:
                return F.when(reason.isNotNull(), whole).when(fits, F.array().cast(_CHUNKS)).otherwise(pieces)
            return F.when(reason.isNotNull() | fits, whole).otherwise(pieces)

        reasons = str_array(["max_seq_len is too small", "start after end", "span longer than a chunk", "slice differs from span text"])
        return F.transform(let(F.get(reasons, fault), out), lambda c: F.struct(prompt.alias("prompt"), c.alias("c"), x["dropped"].alias("dropped")))

    return let((F.lit(max_seq_len - PROMPT_OVERHEAD) - F.length(prompt)).cast("int"), with_capacity)


def _chunk_lists(df: DataFrame, prompts: Sequence[str], max_seq_len: int, text: str, spans: str, strict: bool, entity: str, rejects: bool = False) -> Column:
    """A list for each prompt of the document's chunks, as ``struct(prompt, c, dropped)``."""
    if not prompts:
        raise ValueError("No prompts.")
    whole = F.col(f"`{text}`")
    # Sorted by start, the longest first; `i` keeps the order given.
    ordered = F.array_sort(
        F.transform(
            F.coalesce(F.col(f"`{spans}`"), F.array()),
            lambda s, i: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), i.alias("i"), s[entity].alias("prompt"), s["text"].alias("text")),
        )
    )
    once = let(
        strip_text(whole),
        lambda t: F.struct(
            t.alias("text"), whole.alias("whole"), F.length(t).alias("length"), stripped_prefix(whole).alias("shift"), text_blocks(t).alias("blocks"), ordered.alias("spans")
        ),
    )
    return let(once, lambda d: F.transform(str_array(prompts), lambda p: _of_prompt(d, p, max_seq_len, strict, rejects)))


def _others(df: DataFrame, text: str, spans: str, made: set[str]) -> list[str]:
    others = [c for c in df.columns if c not in {text, spans}]
    if clash := sorted(made.intersection(others)):
        raise ValueError(f"Columns of the result are in the input: {clash}.")
    return others


def chunk_documents(
    df: DataFrame, prompts: Sequence[str], max_seq_len: int = MAX_SEQ_LEN, text: str = "text", spans: str = "spans", strict: bool = True, entity: str = "entity",
    rejects: bool = False,
) -> DataFrame:
    """:func:`chunk_examples` for all prompts of each document, whose spans name their prompt in the field ``entity``.

    The text is stripped and cut into blocks once for all prompts, and the contents of chunks are read before the
    document is expanded, so no copy of its text goes with a chunk. Other columns are kept. A NULL text gives no rows.
    With ``rejects`` only rows with a reason come back, and no content is read for the others.
    """
    others = _others(df, text, spans, {"prompt", "chunk_no", "chunk_start", "content", "result_list", "dropped_spans", REASON})
    plans = F.flatten(_chunk_lists(df, prompts, max_seq_len, text, spans, strict, entity, rejects))
    rows = df.where(F.col(f"`{text}`").isNotNull()).select(*[F.col(f"`{c}`") for c in others], F.explode(plans).alias("__r"))
    dropped = [] if strict else [F.col("__r.dropped").alias("dropped_spans")]
    return rows.select(
        *[F.col(f"`{c}`") for c in others], *dropped, "__r.prompt", "__r.c.chunk_no", "__r.c.chunk_start", "__r.c.content",
        F.col("__r.c.spans").alias("result_list"), F.col("__r.c.reason").alias(REASON),
    )


def chunk_summaries(
    df: DataFrame, prompts: Sequence[str], shown: Callable[[Column], Column], max_seq_len: int = MAX_SEQ_LEN, text: str = "text", spans: str = "spans", strict: bool = True,
    entity: str = "entity",
) -> DataFrame:
    """One row per document and prompt that has chunks: ``prompt, reject_reason, n_chunks, n_spans, pieces``.

    ``pieces`` has ``struct(chunk_no, shown)`` of each chunk in order; chunks are summed up within their document, and
    their contents leave it only as ``shown(chunk)`` says.
    """
    others = _others(df, text, spans, {"prompt", REASON, "n_chunks", "n_spans", "pieces"})

    def summary(rows: Column) -> Column:
        chunks = F.transform(rows, lambda r: F.struct(r["c"]["chunk_no"].alias("chunk_no"), shown(r["c"]).alias("shown")))
        return F.struct(
            rows[0]["prompt"].alias("prompt"), rows[0]["c"]["reason"].alias(REASON), F.size(rows).cast("bigint").alias("n_chunks"),
            F.aggregate(rows, F.lit(0).cast("bigint"), lambda n, r: n + F.size(r["c"]["spans"])).alias("n_spans"), F.array_sort(chunks).alias("pieces"),
        )

    lists = F.filter(_chunk_lists(df, prompts, max_seq_len, text, spans, strict, entity), lambda rows: F.size(rows) > 0)
    found = df.where(F.col(f"`{text}`").isNotNull()).select(*[F.col(f"`{c}`") for c in others], F.explode(F.transform(lists, summary)).alias("__r"))
    return found.select(*[F.col(f"`{c}`") for c in others], "__r.*")
