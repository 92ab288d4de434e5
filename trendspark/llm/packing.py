"""Packing token ids into sequences by concatenating and cutting.

Pass one encodes each partition, numbers the ids from the partition's start and writes them down with the partition's
number. The totals of the partitions, one row each, give every partition its global offset. Pass two cuts each
document where a window of the global stream ends, so a document's pieces, and with them the boundaries inside each
sequence, follow from its global offset alone: no shuffle moves a text or an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.arrow import batch, columns, map_batches, stored
from trendspark.llm.tokens import cuts, id_encoder

_STREAM = "id bigint, part int, local_start bigint, n_ids bigint, ids binary"
_STREAM_ARROW = pa.schema([("id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])
_PIECES = "id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_PIECES_ARROW = pa.schema(
    [("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
# Largest vocabulary whose ids are kept in two bytes between the passes.
_SHORT_IDS = 1 << 16


def token_stream(df: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every text and ``end_id``, with their place in their partition's stream; written to the shared folder.

    Ids are little-endian, in two bytes each where no id of the text needs more, else in four.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = id_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for rows in batches:
            at = 0
            for column in cuts(rows.column(1)):
                ids, offsets = encoder.column(column)
                n = len(column)
                sizes = np.diff(offsets) + 1
                ends = np.cumsum(sizes)
                small = np.append(ids, end_id).max() < _SHORT_IDS
                kind = "<u2" if small else "<u4"
                all_ids = np.insert(ids.astype(kind), offsets[1:], end_id).tobytes()
                width = 2 if small else 4
                starts = ends - sizes
                blobs = [all_ids[width * a : width * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield batch(_STREAM_ARROW, rows.column(0).slice(at, n), np.full(n, part, np.int32), start + starts, sizes, blobs)
                start += int(ends[-1]) if n else 0
                at += n

    source = columns(df, id=id_col, text=text).withColumn("id", F.col("id").cast("bigint"))
    return stored(map_batches(source, task, _STREAM), "token_stream")


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u4" if len(ids) == 4 * n else "<u2").astype("<u4")


def pack(
    df: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces (id, start, length, ids, doc_tokens, sequence_id, offset) of sequences of ``length`` ids.

    Each document gives its ids and ``end_id``. All sequences are full but the last. ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit integers, ``start`` the document's ids before it, ``offset`` its place in the
    sequence: the boundary records of a sequence are its pieces in order of ``offset``. A null text is empty and gives
    the end id alone; rows with equal or null ids are documents of their own; other columns are ignored. The order of
    documents is that of the input's partitions.
    """
    stream = token_stream(df, vocabulary, end_id, id_col, text)
    totals = stream.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per partition of the input.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = stream.join(F.broadcast(bases), "part").select(
        "id", (F.col("base") + F.col("local_start")).alias("at"), "n_ids", "ids"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[list] = [[] for _ in range(7)]
            size = 0
            for doc, at, n, raw in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                ids = _wide(raw, n)
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    taken = min(length - offset, n - start)
                    piece = ids[start : start + taken].tobytes()
                    for values, value in zip(out, (doc, start, taken, piece, n, sequence, offset), strict=True):
                        values.append(value)
                    start += taken
                    size += len(piece)
                if size > 1 << 23:
                    yield batch(_PIECES_ARROW, *out)
                    out, size = [[] for _ in range(7)], 0
            yield batch(_PIECES_ARROW, *out)

    return map_batches(placed, task, _PIECES).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, n_ids, ids, boundaries): the pieces of each sequence put together, a bounded group.

    ``boundaries`` lists (offset, length, document, start) of the pieces in order.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", F.col(id_col).alias("document"), "start", "ids")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("p"))
    return joined.select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("bigint"), lambda n, p: n + p["length"]).alias("n_ids"),
        F.aggregate("p", F.lit(b"").cast("binary"), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
        F.transform("p", lambda p: F.struct(p["offset"], p["length"], p["document"], p["start"])).alias("boundaries"),
    )
