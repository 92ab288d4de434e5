"""Lines that earlier documents hold, found by levelled sorted runs of line hashes.

A run is a table of (two 64-bit hashes, first document), in buckets sorted by hash. A new batch's keys are anti-joined
with all runs, bucket by bucket without moving a run, and what is new becomes a run of the lowest level. When a level
holds ``fanout`` runs they are compacted into one run of the next, so a key is written again a logarithmic number of
times. DataFrame functions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.arrow import columns, stored
from trendspark.session import scratch_path

LEAST_CHARS = 10
BATCHES = 4
FANOUT = 3
# Ids from which the bounds of batches are taken.
BOUND_IDS = 1024
_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]


class LineRuns:
    """Line keys seen so far: sorted runs by level. Each key is in one run, with the document that came first with it."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None) -> None:
        if fanout < 2:
            raise ValueError("a level needs at least two runs to be compacted")
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    @property
    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        # One task a bucket, so that a bucket is one file and its order counts.
        dealt = keys.repartition(self.buckets, *_KEY)
        writer = dealt.write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).format("parquet")
        writer.option("path", scratch_path(self.spark, "line_run")).saveAsTable(name)
        return name

    def add(self, lines: DataFrame) -> None:
        """Take in a batch (h1, h2, id): its new keys become a run, owned by the smallest id of the batch that holds them
        (a null id only if all are null).
        """
        fresh = lines.groupBy(*_KEY).agg(F.min("id").alias("owner"))
        for name in self.names:
            fresh = fresh.join(self.spark.table(name).select(*_KEY), _KEY, "left_anti")
        self._place(self._write(fresh), 0)

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            together = self._write(_union([self.spark.table(n) for n in self.levels[level]]))
            for old in self.levels[level]:
                self.spark.sql(f"DROP TABLE {old}")  # leaves the files to the folder's owner
            self.levels[level] = []
            self._place(together, level + 1)

    def owners(self) -> DataFrame:
        """All keys with their first documents."""
        return _union([self.spark.table(name) for name in self.names])

    def close(self) -> None:
        """Take the runs out of the session's catalogue."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, t, place, h1, h2): every line of (id, t, text) whose key is long enough, by two independent 64-bit hashes."""
    lowered = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    lines = docs.select("id", "t", F.posexplode(F.split(lowered, "\n", -1)).alias("place", "line"))
    keys = lines.select("id", "t", "place", F.btrim("line", F.lit(_SPACE)).alias("key")).filter(F.length("key") >= least_chars)
    return keys.select("id", "t", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _batch_number(ids: DataFrame, batches: int) -> Column:
    """Number of an id's batch: later batches hold larger ids, null ids come with the last."""
    sample = ids.filter(F.col("id").isNotNull()).orderBy(F.xxhash64("id")).limit(BOUND_IDS).collect()
    known = sorted(r[0] for r in sample)
    bounds = sorted({known[len(known) * k // batches] for k in range(1, batches)}) if known else []
    passed = [F.when(F.col("id").isNull() | (F.col("id") >= F.lit(b)), 1).otherwise(0) for b in bounds]
    return reduce(Column.__add__, passed, F.lit(0))


def repeated_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, t, places): the ascending places of lines of (id, t, text) whose key a document with a smaller id holds too."""
    spark = docs.sparkSession
    number = _batch_number(docs.select("id"), batches)
    path = scratch_path(spark, "line_keys")
    line_keys(docs, least_chars).withColumn("batch", number).write.partitionBy("batch").parquet(path)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, t bigint, place int, h1 bigint, h2 bigint, batch int"
    lines = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, fanout)
    for k in range(batches):
        runs.add(lines.filter(F.col("batch") == k))
    # A line stays where its document came first with the key. The id is part of what meets, so a line that very many
    # documents hold is spread like any other.
    owners = runs.owners()
    first = (lines["h1"] == owners["h1"]) & (lines["h2"] == owners["h2"]) & lines["id"].eqNullSafe(owners["owner"])
    gone = lines.join(owners, first, "left_anti")
    found = stored(gone.groupBy("id", "t").agg(F.sort_array(F.collect_set("place")).alias("places")), "repeated_lines")
    runs.close()
    return found


def _kept(text: Column, places: Column) -> Column:
    """The text without the lines at ``places``: runs of kept lines between dropped ones."""
    lines = F.split(text, "\n", -1)
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1))
    ends = F.concat(places, F.array(F.size(lines)))
    runs = F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a))
    return F.array_join(F.flatten(runs), "\n")


def dedup_lines(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    batches: int = BATCHES,
    fanout: int = FANOUT,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text): every row with its repeated lines taken out.

    A line's key is the line with white space of ASCII stripped and A-Z lower-cased. Lines whose key has ``least_chars``
    code points or more stay only in the document with the smallest id that holds the key, there every time. Shorter
    keys always stay. A null text is empty: one empty line. Rows of one id are one document, as are all rows
    without an id, which come last; each row is returned, repeated rows each. An empty table has no rows. Other columns
    are not read. One text's lines meet in one row, as its text does.
    """
    docs = columns(df, id=id_col, text=text_col)
    # Rows of one id are told apart by their text.
    docs = docs.select("id", "text", F.xxhash64("text").alias("t"))
    gone = repeated_lines(docs, batches, fanout, least_chars).select(F.col("id").alias("of"), F.col("t").alias("u"), "places")
    text = F.coalesce("text", F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    joined = docs.join(gone, F.col("id").eqNullSafe(F.col("of")) & (F.col("t") == F.col("u")), "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        (breaks + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("places").isNull(), text).otherwise(_kept(text, F.col("places"))).alias("kept_text"),
    )
