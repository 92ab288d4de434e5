"""k nearest neighbours by Euclidean distance, exact or approximate, without a copy of a vector for each cell it meets.

Base rows go to the cell of their nearest pivot and are packed into parcels, queries into chunks; both move through one
shuffle. A task holds one chunk and streams the stored parcels past it, so a vector is never written again for a cell that
a query visits, and no pair is emitted unless it is among a query's k best. A query skips the cells and blocks that the
triangle inequality rules out. Parcels, chunks and blocks are of bounded size, whatever a cell's share of the data.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.hashing import keyed_hash
from trendspark.session import c, durable

# (queries, base, vec, k, query key, base key, exclude_self=...) to (qid, bid, distance, rank).
Search = Callable[..., DataFrame]

BLOCK_ROWS = 4096
MAX_PIVOTS = 256
# Vectors of a parcel or chunk, as doubles, and of the base rows that one task packs.
PARCEL_BYTES = 4 << 20
PACK_BYTES = 16 << 20
# Fewer queries than this do not need another task.
LEAST_CHUNK = 512
# Numbers of one step of vectorised work: bounds the temporary arrays.
STEP = 1 << 20
# Lengths whose squares are safe in single precision.
SINGLE = (1e-20, 1e30)


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of doubles; a missing number is NaN."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes != dims).any():
        raise ValueError(f"vectors of {dims} numbers expected, found {sorted({*sizes.tolist()})[:3]}")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(vectors), dims)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _pivots(base: DataFrame, count: int, seed: int) -> np.ndarray:
    """``count`` hash-chosen base vectors: at most MAX_PIVOTS rows on the driver."""
    rows = base.orderBy(keyed_hash("id", seed), "id").limit(count).select("vec").collect()
    pivots = np.array([r[0] for r in rows], dtype=np.float64).reshape(len(rows), -1 if rows[0][0] else 0)
    known = np.isfinite((pivots * pivots).sum(1))
    return pivots[known] if known.any() else np.zeros((1, pivots.shape[1]))


def _keys(ids: pa.Array, nullable: bool) -> np.ndarray:
    """Keys that compare as Spark sorts them: with ``nullable`` as (1, key), a missing one as (0,)."""
    if not nullable:
        return ids.to_pandas().to_numpy()
    out = np.empty(len(ids), dtype=object)
    out[:] = [(0,) if key is None else (1, key) for key in ids.to_pylist()]
    return out


def _ids(keys: np.ndarray, kind: pa.DataType, nullable: bool) -> pa.Array:
    if nullable:
        return pa.array([key[1] if key[0] else None for key in keys], kind)
    return pa.array(keys, kind) if keys.dtype == object else pa.array(keys).cast(kind)


def _stream(rows: pa.RecordBatch) -> bytes:
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, rows.schema) as stream:
            stream.write_batch(rows)
        return sink.getvalue().to_pybytes()


def _packed(ids: pa.Array, vectors: np.ndarray, **more: np.ndarray) -> bytes:
    """Rows as Arrow's stream format; vectors that single precision holds exactly take half the room."""
    with np.errstate(over="ignore"):
        single = vectors.astype(np.float32)
    flat = (single if (single == vectors).all() else vectors).ravel()
    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    columns = {"id": ids, "vec": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))}
    return _stream(pa.RecordBatch.from_pydict(columns | {name: pa.array(values) for name, values in more.items()}))


def _unpacked(data: bytes, dims: int) -> tuple[pa.RecordBatch, np.ndarray]:
    rows = pa.ipc.open_stream(pa.py_buffer(data)).read_next_batch()
    return rows, _matrix(rows.column("vec"), dims)


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``most``."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - rows)
            waiting.append(part)
            rows, batch = rows + len(part), batch.slice(len(part))
            if rows == most:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _needed_copies(vectors: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among some query's k nearest: of equal vectors the first k + 1 keys do, k rows of each."""
    plain = np.ascontiguousarray(vectors + 0.0).view(np.dtype((np.void, max(1, vectors.shape[1] * 8)))).ravel() if vectors.size else np.zeros(len(vectors))
    _, group, sizes = np.unique(plain, return_inverse=True, return_counts=True)
    keep = np.ones(len(vectors), bool)
    if sizes.max(initial=0) <= k + 1:
        return keep
    crowded = np.flatnonzero(sizes[group] > k + 1)
    crowded = crowded[np.lexsort((keys[crowded], group[crowded]))]
    g, key = group[crowded], keys[crowded]
    at = np.arange(len(crowded))
    new_group = np.r_[True, g[1:] != g[:-1]]
    new_key = new_group | np.r_[True, key[1:] != key[:-1]]
    number = np.cumsum(new_key)
    in_group = number - number[np.maximum.accumulate(np.where(new_group, at, 0))]
    in_key = at - np.maximum.accumulate(np.where(new_key, at, 0))
    keep[crowded] = (in_group <= k) & (in_key < k)
    return keep


@dataclass(frozen=True)
class _Cells:
    """What every task knows of the base rows."""

    pivots: np.ndarray
    radius: np.ndarray
    members: np.ndarray
    # Rows of which k are left if those of one key are not counted.
    need: int
    probes: int | None

    def visits(self, d: np.ndarray) -> np.ndarray:
        """The cells that each query has to visit, by its distances from the pivots."""
        # Upper bound of the k-th distance: the nearest cells that together hold enough rows.
        far = np.where(np.isfinite(self.radius), d + self.radius, np.inf)
        by_far = np.argsort(far, axis=1)
        enough = (np.cumsum(self.members[by_far], axis=1) >= self.need).argmax(1)
        bound = np.take_along_axis(far, by_far, 1)[np.arange(len(d)), enough]
        if self.members.sum() < self.need:
            bound = np.full(len(d), np.inf)
        hit = np.isfinite(self.radius)[None, :] & (d - self.radius[None, :] <= bound[:, None] + self.margin(d))
        if self.probes is not None:
            hit &= d.argsort(axis=1).argsort(axis=1) < self.probes
        return hit

    def margin(self, d: np.ndarray) -> np.ndarray:
        """What the product form of a distance can be wrong by."""
        return 1e-6 * (1.0 + np.abs(d) + math.sqrt((self.pivots**2).sum(1).max(initial=0.0)))


def _true_places(flags: np.ndarray, count: int) -> np.ndarray:
    """Places of the true among the first ``count`` flags, looking at eight at once; flags beyond them are lost."""
    whole = -(-count // 8) * 8
    flags[count:whole] = False
    places = (np.flatnonzero(flags[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return places[flags[places]]


class _Chunk:
    """Queries of one task, and the k best base rows that each has met."""

    def __init__(self, data: bytes, cells: _Cells, k: int, exclude_self: bool, nullable: bool) -> None:
        rows, self.vectors = _unpacked(data, cells.pivots.shape[1])
        self.ids, self.cells, self.k, self.nullable = rows.column("id"), cells, k, nullable
        self.centre = cells.pivots.mean(0)
        self.d = _distances(self.vectors, cells.pivots)
        self.visits = cells.visits(self.d)
        moved = self.vectors - self.centre
        self.square = (moved * moved).sum(1)
        with np.errstate(over="ignore"):
            self.single = np.hstack([moved, np.ones((len(moved), 1))]).astype(np.float32)
        self.far = np.full((len(moved), k), np.inf)
        # Used again by every step.
        self.room = np.empty(STEP, np.float32), np.empty(STEP, bool)
        self.keys: np.ndarray | None = None
        self.kind: pa.DataType | None = None
        self.same: dict = defaultdict(list)
        if exclude_self:
            known = np.flatnonzero(self.ids.is_valid().to_numpy(zero_copy_only=False))
            for i, key in zip(known.tolist(), _keys(self.ids.take(pa.array(known)), nullable).tolist(), strict=True):
                self.same[key].append(i)

    def meet(self, data: bytes, block_rows: int) -> None:
        """Measure the rows of a parcel, one block of a cell at a time."""
        rows, vectors = _unpacked(data, self.vectors.shape[1])
        keys, self.kind = _keys(rows.column("id"), self.nullable), rows.schema.field("id").type
        if self.keys is None:
            self.keys = np.empty((len(self.ids), self.k), dtype=keys.dtype)
        cell, reach = (rows.column(name).to_numpy() for name in ("cell", "reach"))
        edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            for start in range(first, last, min(block_rows, STEP)):
                part = slice(start, min(start + min(block_rows, STEP), last))
                self._block(keys[part], vectors[part], cell[first], reach[part])

    def _block(self, keys: np.ndarray, b: np.ndarray, cell: int, reach: np.ndarray) -> None:
        d, bound = self.d[:, cell], self.far[:, -1]
        least = np.maximum(d - reach.max(), reach.min() - d)
        asked = np.flatnonzero(self.visits[:, cell] & (least <= bound + self.cells.margin(d)))
        if not len(asked):
            return
        moved = b - self.centre
        square = (moved * moved).sum(1)
        own = np.full(len(self.ids), -1)
        own[asked] = np.arange(len(asked))
        alike = [(own[i], j) for j, key in enumerate(keys.tolist()) for i in self.same.get(key, ()) if own[i] >= 0] if self.same else []
        mine, theirs = np.array(sorted(alike), dtype=np.int64).reshape(-1, 2).T
        most = max(square.max(), self.square[asked].max())
        half = np.hstack([moved, -0.5 * square[:, None]])
        single = half.astype(np.float32) if SINGLE[0] < most < SINGLE[1] else None
        step = max(1, STEP // len(b))
        for start in range(0, len(asked), step):
            queries = asked[start : start + step]
            first, last = np.searchsorted(mine, [start, start + len(queries)])
            without = (mine[first:last] - start, theirs[first:last])
            row, col = self._near(queries, half, single, square.max(), without)
            self._take(queries[row], keys, b, col)

    def _near(self, queries: np.ndarray, half: np.ndarray, single: np.ndarray | None, most: float, without: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(row, col) of the pairs that can be among the k nearest. A pair's nearness is q.b - |b|^2 / 2: larger is nearer."""
        dims, length = half.shape[1] - 1, self.square[queries]
        bound = self.far[queries, -1]
        with np.errstate(over="ignore", invalid="ignore"):
            floor = np.maximum((length - bound * bound) / 2, -1e300)
        size = length + most
        if single is not None:
            # Single precision leaves out what is clearly too far.
            slack = (dims + 8) * 2.5e-7 * size + 2.5e-7 * np.abs(np.maximum(floor, -1e37)) + 1e-30
            pairs = len(queries) * len(half)
            near, hit = (room[:pairs].reshape(len(queries), len(half)) for room in self.room)
            np.matmul(self.single[queries], single.T, out=near)
            near[without] = -np.inf
            np.greater_equal(near, np.maximum(floor - slack, -1e37).astype(np.float32)[:, None], out=hit)
            row, col = np.divmod(_true_places(self.room[1], pairs), len(half))
            many = np.bincount(row, minlength=len(queries)) > 2 * self.k + 64
            if not many.any():
                return row, col
            few = ~many[row]
            row, col = row[few], col[few]
        else:
            many = np.ones(len(queries), bool)
            row = col = np.zeros(0, np.int64)
        # The others are told apart in double precision, by the k-th nearest of this block too.
        among = np.flatnonzero(many)
        place = np.full(len(queries), -1)
        place[among] = np.arange(len(among))
        q = np.hstack([self.vectors[queries[among]] - self.centre, np.ones((len(among), 1))])
        near = q @ half.T
        hidden = place[without[0]] >= 0
        near[place[without[0][hidden]], without[1][hidden]] = -np.inf
        slack = (dims + 8) * 1e-15 * (size[among] + np.sqrt(size[among]) * math.sqrt((self.centre**2).sum()))
        least = floor[among] - slack
        if near.shape[1] > self.k:
            least = np.maximum(least, np.partition(near, -self.k, axis=1)[:, -self.k] - 2 * slack)
        more, there = np.nonzero(near >= np.maximum(least, -1e300)[:, None])
        return np.r_[row, among[more]], np.r_[col, there]

    def _take(self, row: np.ndarray, keys: np.ndarray, b: np.ndarray, col: np.ndarray) -> None:
        """Measure the pairs exactly and keep each query's k best, ties by key."""
        # The product form rounds: measure the nearest again, exactly.
        far, piece = np.empty(len(row)), max(1, STEP // max(1, b.shape[1]))
        for i in range(0, len(row), piece):
            far[i : i + piece] = np.sqrt(((b[col[i : i + piece]] - self.vectors[row[i : i + piece]]) ** 2).sum(1))
        good = np.flatnonzero(np.isfinite(far) & (far <= self.far[row, -1]))
        if not len(good):
            return
        row, far, key = row[good], far[good], keys[col[good]]
        held = np.unique(row)
        old_row, old_place = np.nonzero(np.isfinite(self.far[held]))
        old_row = held[old_row]
        row, far = np.r_[row, old_row], np.r_[far, self.far[old_row, old_place]]
        key = np.concatenate([key, self.keys[old_row, old_place]])
        order = np.lexsort((key, far, row))
        row, far, key = row[order], far[order], key[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        place = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        best = place < self.k
        self.far[row[best], place[best]] = far[best]
        self.keys[row[best], place[best]] = key[best]

    def found(self) -> Iterator[bytes]:
        step = max(1, STEP // 8 // self.k)
        for start in range(0, len(self.ids) if self.keys is not None else 0, step):
            part = slice(start, start + step)
            row, place = np.nonzero(np.isfinite(self.far[part]))
            if len(row):
                bids = _ids(self.keys[part][row, place], self.kind, self.nullable)
                out = pa.RecordBatch.from_arrays(
                    [self.ids.take(pa.array(row + start)), bids, pa.array(self.far[part][row, place])], names=["qid", "bid", "distance"]
                )
                yield _stream(out)


def _search(cells: _Cells, k: int, exclude_self: bool, nullable: bool, block_rows: int):
    def run(pairs: Iterable) -> Iterator[tuple[bytes]]:
        chunks: dict[str, _Chunk] = {}
        for asked, parcel in pairs:
            chunk = chunks.get(asked["chunk"])
            if chunk is None:
                chunk = chunks[asked["chunk"]] = _Chunk(asked["data"], cells, k, exclude_self, nullable)
            chunk.meet(parcel["data"], block_rows)
        for chunk in chunks.values():
            for data in chunk.found():
                yield (data,)

    return run


def _cells(size: int, block_rows: int) -> int:
    """One cell while a block holds everything; then enough cells for pruning, up to a fixed number."""
    return 1 if size <= block_rows else min(MAX_PIVOTS, 2 + int(math.sqrt(size / block_rows) * 4))


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    vec: str,
    k: int,
    query_key: str = "id",
    base_key: str = "id",
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    seed: int = 42,
    probes: int | None = None,
    probe_share: float | None = None,
) -> DataFrame:
    """(qid, bid, distance, rank): the k nearest base rows of each query, ties by base key.

    With ``probes`` the answer is approximate: a query visits only the cells of its ``probes`` nearest pivots, so its
    cost does not grow with the cells. With ``probe_share`` it visits that share of the cells, so that recall holds as
    their number grows. ``recall`` measures what is lost.
    """
    b = base.select(c(base_key).alias("id"), c(vec).cast("array<double>").alias("vec")).filter("vec is not null")
    q = queries.select(c(query_key).alias("id"), c(vec).cast("array<double>").alias("vec")).filter("vec is not null")
    key_type, base_type = q.schema["id"].dataType, b.schema["id"].dataType
    out_schema = T.StructType(
        [T.StructField("qid", key_type), T.StructField("bid", base_type), T.StructField("distance", T.DoubleType())]
    )

    of_key = b.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    whole = of_key.agg(F.sum("n").alias("n"), F.max(F.when(c("id").isNotNull(), c("n"))).alias("most"), F.count_if(c("id").isNull()).alias("nulls")).first()
    size, nullable = whole["n"] or 0, whole["nulls"] > 0
    if size == 0:
        return q.sparkSession.createDataFrame([], out_schema).withColumn("rank", F.lit(1))
    pivots = _pivots(b, _cells(size, block_rows), seed)
    if probe_share is not None:
        probes = max(probes or 0, math.ceil(probe_share * len(pivots)))
    dims = pivots.shape[1]
    row_bytes = 8 * max(dims, 1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vec"), dims)
            known = np.flatnonzero(np.isfinite((vectors * vectors).sum(1)))
            d = _distances(vectors[known], pivots)
            cell = d.argmin(1)
            kept = batch.take(pa.array(known))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(cell.astype("int32")), pa.array(d[np.arange(len(d)), cell])], names=["id", "vec", "cell", "reach"]
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, max(1, PARCEL_BYTES // row_bytes)):
            vectors, ids = _matrix(batch.column("vec"), dims), batch.column("id")
            cell, reach = (batch.column(name).to_numpy() for name in ("cell", "reach"))
            there, start, n = np.unique(cell, return_index=True, return_counts=True)
            keep = np.flatnonzero(_needed_copies(vectors, _keys(ids, nullable), k))
            data = _packed(ids.take(pa.array(keep)), vectors[keep], cell=cell[keep], reach=reach[keep])
            stats = [{"cell": int(x), "n": int(y), "radius": float(z)} for x, y, z in zip(there, n, np.maximum.reduceat(reach, start), strict=True)]
            kind = pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64()), ("radius", pa.float64())]))
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([stats], kind)], names=["data", "cells"])

    placed = b.mapInArrow(assign, T._parse_datatype_string(f"id {base_type.simpleString()}, vec array<double>, cell int, reach double"))
    # Rows are dealt out evenly, whatever their cell, and sorted by it within a task.
    sorted_rows = placed.repartition(-(-size * row_bytes // PACK_BYTES)).sortWithinPartitions("cell", "reach")
    parcels = durable(sorted_rows.mapInArrow(pack, "data binary, cells array<struct<cell int, n bigint, radius double>>"), "knn-base")
    stats = (
        parcels.select(F.inline("cells"))
        .groupBy("cell")
        .agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))
        .collect()  # one row per pivot
    )
    radius = np.full(len(pivots), -np.inf)
    members = np.zeros(len(pivots), dtype=np.int64)
    for row in stats:
        radius[row["cell"]], members[row["cell"]] = row["radius"], row["n"]
    cells = _Cells(pivots, radius, members, k + (whole["most"] or 0) * exclude_self, probes)

    spark = b.sparkSession
    cores, asked = spark.sparkContext.defaultParallelism, q.count()
    chunk_rows = max(1, PARCEL_BYTES // (8 * max(dims, len(pivots) // 4, 2 * k)))
    tasks = max(-(-asked // chunk_rows), min(-(-asked // LEAST_CHUNK), 2 * cores), 1)
    tasks = -(-tasks // cores) * cores if tasks > cores else tasks

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, chunk_rows + chunk_rows // 4 + 1):
            vectors = _matrix(batch.column("vec"), dims)
            known = np.flatnonzero(np.isfinite((vectors * vectors).sum(1)))
            if len(known):
                data = _packed(batch.column("id").take(pa.array(known)), vectors[known])
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([data], pa.binary())], names=["chunk", "data"])

    chunks = q.repartition(tasks).mapInArrow(gather, "chunk string, data binary")
    # Each task has one partition of chunks and reads all parcels, one after another, from the shared folder.
    pairs = chunks.rdd.cartesian(parcels.select("data").coalesce(1).rdd)
    found = spark.createDataFrame(pairs.mapPartitions(_search(cells, k, exclude_self, nullable, block_rows)), "data binary", verifySchema=False)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                yield from pa.ipc.open_stream(data.as_buffer())

    best = durable(found.mapInArrow(spread, out_schema), "knn-best")
    nearest = Window.partitionBy("qid").orderBy("distance", "bid")
    return best.withColumn("rank", F.row_number().over(nearest)).filter(c("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(wanted, hit, recall): the share of exact neighbours that an approximate join found."""
    wanted = exact.select("qid", "bid").withColumn("wanted", F.lit(1))
    both = wanted.join(found.select("qid", "bid").withColumn("hit", F.lit(1)), ["qid", "bid"], "left")
    counts = both.agg(F.count("wanted").alias("wanted"), F.count("hit").alias("hit"))
    return counts.withColumn("recall", F.try_divide(c("hit").cast("double"), c("wanted")))


def knn_brute(queries: np.ndarray, base: np.ndarray, k: int) -> list[list[int]]:
    """Plain reference for tests: row numbers of the k nearest, ties by row number."""
    out = []
    for q in queries:
        d = np.sqrt(((base - q) ** 2).sum(1))
        out.append([int(i) for i in np.lexsort((np.arange(len(base)), d))[:k]])
    return out
