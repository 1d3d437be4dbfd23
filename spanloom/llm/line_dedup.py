"""Lines that many documents hold, by levelled sorted runs of line hashes, with DataFrame functions only.

A run is a table of line keys (two 64-bit hashes), the number of documents that hold each and the largest of their
ids, cut into buckets by key and sorted within them. Documents come in batches. A batch is counted by key,
merge-anti-joined with the runs, which leaves out what they already settle (enough documents, none of them before
the batch's largest id), and the rest becomes a run of its own. When a level has ``fan_out`` runs, they are merged
bucket by bucket into one run of the next level. Neither the joins nor the merges move a run.

Batches of one table come by falling ids, so that the first documents of a frequent line settle it.

Cases: a document is a ``doc_id``, so its lines in several rows count once; a NULL id is a document, the smallest;
a NULL or empty text is one empty line; repeated rows are all returned, each with the same result; an empty table
gives no rows; very long texts and lines are read whole; ties cannot occur, as ids are compared alone and all lines
of the largest id stay; further columns are not looked at.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import let
from ..session import shared_folder
from .common import id_and_text, shuffle_files_released, shuffle_parts, written

KEY = ["h1", "h2"]
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is hot when more than one line in so many has it: fewer than this many keys are, so they may be broadcast.
HOT_SHARE = 5_000
#: A key with no more documents than this is never hot.
HOT_ROWS = 1_000


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_places(rows: DataFrame, least_chars: int) -> DataFrame:
    """``doc_id, code, at, h1, h2``: where lines of at least ``least_chars`` code points stand in ``rows (doc_id, text)``."""
    lines = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("code"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    long = lines.filter(F.length(F.btrim("line", F.lit(WHITE))) >= least_chars)
    key = line_key(F.col("line"))
    return long.select("doc_id", "code", "at", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


@contextlib.contextmanager
def _sorted_buckets(spark: SparkSession):
    """Within it, scans of buckets of one file each say that they are sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        with shuffle_files_released(spark):
            yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """The levelled runs: ``levels[i]`` lists the tables of level ``i``, oldest first."""

    def __init__(self, spark: SparkSession, documents: int, fan_out: int = 2, buckets: int | None = None):
        if fan_out < 2:
            raise ValueError("fan_out is at least 2")
        self.spark, self.documents, self.fan_out = spark, documents, fan_out
        self.buckets = buckets or shuffle_parts(spark)
        self.folder = f"{shared_folder(spark)}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_) -> None:
        for name in [name for level in self.levels for name in level]:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the catalogue's entry; files belong to the folder

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        with _sorted_buckets(self.spark):
            run.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """Several runs as one: the documents of a key are added up, since a document is in one batch only.

        Merge joins, as a union of bucketed scans doesn't bring equal buckets together.
        """
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(*[F.col(c).alias(f"other_{c}") for c in rows.columns])
            pairs = rows.join(other, (F.col("h1") == F.col("other_h1")) & (F.col("h2") == F.col("other_h2")), "full_outer")
            documents = F.coalesce("documents", F.lit(0)) + F.coalesce("other_documents", F.lit(0))
            rows = pairs.select(*[F.coalesce(k, f"other_{k}").alias(k) for k in KEY], documents.alias("documents"), F.greatest("keeper", "other_keeper").alias("keeper"))
        return rows

    def add(self, places: DataFrame) -> None:
        """Take in a batch of ``doc_id, h1, h2``; each document's lines come in one batch."""
        counted = places.select("doc_id", *KEY).distinct().groupBy(*KEY).agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
        with _sorted_buckets(self.spark):
            for name in [name for level in self.levels for name in level]:
                run = self.spark.table(name).filter(F.col("documents") >= self.documents).select(*[F.col(k).alias(f"run_{k}") for k in [*KEY, "keeper"]])
                same = (F.col("h1") == F.col("run_h1")) & (F.col("h2") == F.col("run_h2"))
                counted = counted.join(run, same & (F.col("run_keeper") >= F.col("keeper")), "left_anti")
        self._write(counted, 0)
        self._compact(0)

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        if len(names) < self.fan_out:
            return
        self._write(self._merged(names), level + 1)
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels[level] = []
        self._compact(level + 1)

    def frequent(self) -> DataFrame:
        """``h1, h2, documents, keeper`` of the keys that enough documents hold.

        ``documents`` may leave out documents that came when the key was settled; it is never too large.
        """
        names = [name for level in self.levels for name in level]
        if not names:
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint, documents bigint, keeper bigint")
        with _sorted_buckets(self.spark):
            return written(self._merged(names).filter(F.col("documents") >= self.documents))


def _batched(rows: DataFrame, batches: int) -> Column:
    """The batch of a row: documents with larger ids come first, NULL ids last."""
    shares = F.array(*[F.lit(i / batches) for i in range(1, batches)])
    bounds = rows.agg(F.percentile_approx("doc_id", shares, F.lit(1_000)).alias("b")).first()["b"] if batches > 1 else None
    number = F.lit(0)
    for bound in bounds or []:
        number = number + F.coalesce((F.col("doc_id") < F.lit(bound)).cast("int"), F.lit(1))
    return number.cast("int")


def repeated_places(places: DataFrame, frequent: DataFrame, lines: int) -> DataFrame:
    """``doc_id, code, places``: of each document the places of frequent lines of which it isn't the keeper."""
    most = max(HOT_ROWS, lines // HOT_SHARE)
    keepers = frequent.select(*KEY, "keeper", "documents")
    # How often a key stands in the lines is counted anew, as the runs leave out documents of settled keys.
    hot = places.groupBy(*KEY).agg(F.count("*").alias("n")).filter(F.col("n") > most).select(*KEY)
    hot = F.broadcast(written(hot.join(keepers, KEY).select(*KEY, "keeper").coalesce(1)))  # fewer than HOT_SHARE rows
    rest = places.join(hot.drop("keeper"), KEY, "left_anti").join(keepers.drop("documents"), KEY)
    found = places.join(hot, KEY).unionByName(rest).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return found.groupBy("doc_id", "code").agg(F.collect_set("at").alias("places"))


def deduplicated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, documents: int = 5, batches: int = 4, fan_out: int = 2) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for each row.

    Lines whose key has at least ``least_chars`` code points and stands in at least ``documents`` documents go, but
    for those of the largest id that holds the key.
    """
    rows = id_and_text(docs, id_col, text_col)
    places = written(line_places(rows, least_chars).withColumn("batch", _batched(rows, batches)))
    with LineRuns(docs.sparkSession, documents, fan_out) as runs:
        for batch in range(batches):
            runs.add(places.filter(F.col("batch") == batch))
        frequent = runs.frequent()
    gone = written(repeated_places(places.drop("batch"), frequent, places.count()))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("code").alias("gone_code"), "places")
    coded = rows.withColumn("code", F.xxhash64("doc_id", "text"))
    joined = coded.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("code") == F.col("gone_code")), "left")

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("places"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    split = F.split("text", "\n", -1)
    return joined.select(
        "doc_id", F.size(split).cast("bigint").alias("n_lines"), F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("bigint").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.col("text")).otherwise(let(split, rest)).alias("kept"),
    )
