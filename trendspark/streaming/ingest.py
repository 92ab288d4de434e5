"""Incremental, restartable ingestion of record files.

Every batch folder of the sink has a key index beside it: the range of its keys and a Bloom filter of their hashes. A new
batch opens only the folders that may hold one of its keys, and then joins their keys exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.operators.dedupe import dedupe_key
from trendspark.operators.joins import exclude_known
from trendspark.session import c, durable
from trendspark.sources.readers import list_names

# Bits a key and hash values of it: a key that is not there passes with a chance of 1 in 400.
KEY_BITS = 16
PROBES = 4
# Larger batches have a range only; and filters of more bytes together are not sent to tasks.
FILTER_KEYS = 1 << 22
SENT_BYTES = 64 << 20
_BITMAP = 1 << 15  # bits of one of Spark's bitmaps


def resume_pending(ids: DataFrame, progress: DataFrame, key: str) -> DataFrame:
    """Ids not processed yet."""
    return exclude_known(ids, progress, key)


def read_sink(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """The ingested rows; empty before the first batch."""
    if not list_names(spark, sink):
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(full).parquet(sink).select(*[c(f.name) for f in schema.fields])


def _index_path(sink: str) -> str:
    return f"{sink.rstrip('/')}_keys"


def _hashes(name: str) -> Column:
    """The hash values of a key that set its places in a filter."""
    return F.array(*[F.xxhash64(c(name), F.lit(i)) for i in range(PROBES)])


def write_key_index(spark: SparkSession, sink: str, folder: str, key: str, kind: T.DataType) -> None:
    """Index one batch folder: (lo, hi, size, part, bits), a row for each 32,768 bits of its filter.

    Without keys there are no rows; without a filter, one of size 0.
    """
    keys = spark.read.schema(T.StructType([T.StructField(key, kind)])).parquet(f"{sink}/{folder}").select(c(key).alias("k"))
    lo, hi, n = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
    size = max(_BITMAP, 1 << math.ceil(math.log2(KEY_BITS * max(n, 1))))
    if n <= FILTER_KEYS:
        spots = keys.filter("k IS NOT NULL").select(F.explode(_hashes("k")).alias("h")).select(c("h").bitwiseAND(F.lit(size - 1)).alias("spot"))
        part = (c("spot") / _BITMAP).cast("bigint").alias("part")
        bits = spots.groupBy(part).agg(F.bitmap_construct_agg(c("spot") % _BITMAP).alias("bits"))
    else:
        size = 0
        bits = spark.range(1).select(c("id").alias("part"), F.lit(b"").alias("bits"))
    ends = [F.lit(lo).cast(kind).alias("lo"), F.lit(hi).cast(kind).alias("hi"), F.lit(size).cast("bigint").alias("size")]
    bits.select(*ends, "part", "bits").write.mode("overwrite").parquet(f"{_index_path(sink)}/{folder}")


def folders_to_open(spark: SparkSession, sink: str, folders: Sequence[str], keys: DataFrame, key: str) -> list[str]:
    """Those of the sink's folders that may hold a key of the table ``keys``; a folder without an index may."""
    path = _index_path(sink)
    indexed = [f for f in folders if f in set(list_names(spark, path))]
    out = [f for f in folders if f not in indexed]
    lo, hi = keys.agg(F.min(key), F.max(key)).first()
    if not indexed or lo is None:
        return out
    index = spark.read.parquet(*[f"{path}/{f}" for f in indexed]).withColumn("folder", F.element_at(F.split(F.input_file_name(), "/"), -2))
    near = [r for r in index.select("folder", "lo", "hi", "size").distinct().collect() if r["lo"] is not None and r["lo"] <= hi and lo <= r["hi"]]
    near.sort(key=lambda r: r["size"])
    sent, tested = 0, []
    for r in near:
        sent += r["size"] // 8
        if r["size"] and sent <= SENT_BYTES:
            tested.append(r["folder"])
        else:
            out.append(r["folder"])
    if not tested:
        return out
    filters = {r["folder"]: np.zeros(r["size"] // 8, np.uint8) for r in near if r["folder"] in tested}
    for r in index.filter(c("folder").isin(tested)).select("folder", "part", "bits").toLocalIterator():
        at = r["part"] * (_BITMAP // 8)
        filters[r["folder"]][at : at + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = spark.sparkContext.broadcast(filters)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = set()
        for batch in batches:
            hashes = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, PROBES)
            for folder, bits in shared.value.items():
                if folder not in open_:
                    spot = hashes & (8 * len(bits) - 1)
                    if (bits[spot >> 3] >> (spot & 7) & 1 > 0).all(axis=1).any():
                        open_.add(folder)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(open_), pa.string())], ["folder"])

    hit = keys.filter(c(key).isNotNull()).select(_hashes(key).alias("h")).mapInArrow(probe, "folder string").distinct().collect()
    shared.unpersist()
    return out + [r["folder"] for r in hit]


def incremental_ingest(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType,
    key: str,
    order: Sequence[str],
    files_per_batch: int | None = None,
) -> DataFrame:
    """Read new JSON files, keep the first row per key over all batches, append to ``sink``.

    Each batch owns one sink folder and overwrites it, so a batch replayed
    after a crash replaces its own output instead of adding to it. Only the key
    column is read back, of the folders whose index may hold a key of the batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, own = batch.sparkSession, f"batch={batch_id}"
        rows = dedupe_key(batch.filter(c(key).isNotNull()), key, order)
        others = [n for n in list_names(session, sink) if n.startswith("batch=") and n != own]
        if others:
            rows = durable(rows, "ingest-batch")
            others = folders_to_open(session, sink, others, rows, key)
        if others:
            known = session.read.schema(T.StructType([schema[key]])).parquet(*[f"{sink}/{n}" for n in others])
            rows = exclude_known(rows, known, key).select(*[f.name for f in schema.fields])
        rows.write.mode("overwrite").parquet(f"{sink}/{own}")
        write_key_index(session, sink, own, key, schema[key].dataType)

    query = (
        reader.json(source)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return read_sink(spark, sink, schema)
