"""A corpus as files of token ids, in ascending order of document id.

Texts are range-partitioned by id, each task encodes its range and writes one file, and the list of files is a table
written by Spark's own commit. A file's name holds the task attempt, so a lost or repeated task never spoils a listed
file; files that no list names belong to failed attempts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.llm import simple8b
from trendspark.llm.arrow import batch, columns, map_batches
from trendspark.llm.tokens import cuts, id_encoder

_FILES = "part int, path string, n_docs bigint, n_ids bigint, n_bytes bigint"
_FILES_ARROW = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
_DOCS = "id bigint, start bigint, n_tokens bigint, ids binary"
_DOCS_ARROW = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _opened(url: str):
    """File system and path of a URL, for any store pyarrow knows."""
    from pyarrow import fs

    if "://" not in url and not url.startswith("file:"):
        return fs.LocalFileSystem(), url
    return fs.FileSystem.from_uri(url if "://" in url else "file://" + url.removeprefix("file:"))


def write_token_files(
    df: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the ids of every text and ``end_id`` below ``folder``, documents in ascending order of id.

    Null ids come first, a null text is empty, rows of equal ids stay documents of their own, next to each other.
    Returns the committed list of files (part, path, n_docs, n_ids, n_bytes), which is also ``folder``/files.
    """
    run = uuid.uuid4().hex[:12]
    data = f"{folder}/data-{run}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encoder, sink, docs, n_ids = id_encoder(vocabulary), None, 0, 0
        store, base = _opened(data)
        path = f"{base}/part-{context.partitionId():06d}-{context.taskAttemptId()}.s8b"
        for rows in batches:
            at = 0
            for column in cuts(rows.column(1)):
                if sink is None:
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(path)
                    writer = simple8b.Writer(sink)
                ids, offsets = encoder.column(column)
                keys = rows.column(0).slice(at, len(column)).to_pylist()
                at += len(column)
                writer.add(keys, np.diff(offsets) + 1, np.insert(ids, offsets[1:], end_id))
                docs, n_ids = docs + len(keys), n_ids + len(ids) + len(keys)
        if sink is not None:
            writer.close()
            size = sink.tell()
            sink.close()
            url = data + path[len(base) :]
            yield batch(_FILES_ARROW, [context.partitionId()], [url], [docs], [n_ids], [size])

    source = columns(df, id=id_col, text=text).withColumn("id", F.col("id").cast("bigint"))
    ordered = source.repartitionByRange("id").sortWithinPartitions("id")
    files = f"{folder}/files"
    map_batches(ordered, task, _FILES).write.mode("overwrite").parquet(files)
    return df.sparkSession.read.parquet(files)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document in the files: ``start`` counts the ids of all documents before it."""
    files = spark.read.schema(_FILES).parquet(f"{folder}/files")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("path", "n_bytes", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for url, size, base in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                store, path = _opened(url)
                with store.open_input_file(path) as source:
                    start = base
                    for keys, sizes, ids in simple8b.read_blocks(source, size):
                        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                        starts = ends - sizes
                        blobs = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                        yield batch(_DOCS_ARROW, keys, start + starts, sizes, blobs)
                        start += int(ends[-1])

    # The list has been gathered for its running total; a file a row, the files are dealt out again.
    spread = listed.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")
    return map_batches(spread, task, _DOCS)
