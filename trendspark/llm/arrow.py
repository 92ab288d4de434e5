"""Arrow batches in and out of tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.session import c, scratch_path

# Texts of one step of vectorised work: bounds the temporary arrays, which take a multiple of it.
STEP_BYTES = 1 << 20


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns of ``df`` (new name to old name), so that no other column can clash."""
    return df.select(*[c(old).alias(new) for new, old in wanted.items()])


def map_batches(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow``; workers are used again by later tasks, so each task gives back what it has freed."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        _give_back()

    return df.mapInArrow(tidy, schema)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder of ``spark.checkpoint.dir`` and read back: what tasks numbered stays as it is."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, *paths: str) -> None:
    """Delete tables written by ``stored_at`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows; a null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts take at most ``limit`` bytes together, or one longer text."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def batch(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a, type=t.type) for a, t in zip(arrays, schema, strict=True)], schema=schema
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def lookup(values: Sequence, index: Column) -> Column:
    """Element of a short constant list, by zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)
