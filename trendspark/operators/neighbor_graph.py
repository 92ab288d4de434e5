"""Approximate nearest neighbours by refining a graph: a neighbour of a neighbour is likely a neighbour.

The graph starts from blocks of rows that lie on the same sides of random planes. In each round every row brings the rows
it is linked with, either way, together once; they measure one another and keep the nearest ``degree``. A row meets at
most ``2 * degree`` others in a round, whatever the number of rows, so the work of a round is bounded by the square of
the degree a row. The rounds end when few links change. ``knn_join`` is the exact form.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.functions.hashing import keyed_hash
from trendspark.operators.dedupe import union_sources
from trendspark.operators.neighbors import knn_join
from trendspark.session import c, durable

DEGREE = 24
ROUNDS = 12
LEAST_CHANGE = 0.02
# Rows of a starting block, and independent sets of blocks.
BLOCK = 64
STARTS = 2
# Rows whose mean the planes pass through.
CENTRE_ROWS = 256


@dataclass
class NeighborGraph:
    """Links (id, nid, square) to the nearest rows found, and the share of links that each round changed."""

    links: DataFrame
    changed: list[float] = field(default_factory=list)


def _flat_matrix(vectors: pa.Array) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(vectors), -1).astype(np.float64) if len(vectors) else np.zeros((0, 0))


def _sides(nodes: DataFrame, planes: int, seed: int) -> DataFrame:
    """Append ``code``: the sides of random planes on which a row lies."""
    sample = nodes.orderBy(keyed_hash("id", seed), "id").limit(CENTRE_ROWS).select("vec").collect()
    centre = np.mean([r[0] for r in sample], axis=0)
    normals = np.random.Generator(np.random.PCG64(seed)).normal(size=(len(centre), planes))
    powers = 1 << np.arange(planes, dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = ((_flat_matrix(batch.column("vec")) - centre) @ normals > 0) @ powers
                yield batch.append_column("code", pa.array(code, pa.int64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(place, f"{kinds}, code bigint")


def _meetings(groups: DataFrame, most: int, id_type: str) -> DataFrame:
    """(id, nid, square): what the members of each group find out about one another.

    A member is told at most ``most`` others: the nearest that beat its bound, one of the two being fresh.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            flat = lists.flatten()
            if not len(flat):
                continue
            ids, vectors = flat.field("id"), _flat_matrix(flat.field("vec"))
            base, fresh = (flat.field(n).to_numpy(zero_copy_only=False).astype(bool) for n in ("base", "fresh"))
            bound = flat.field("bound").to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            told, about, far = [], [], []
            for first, last in zip([0, *ends[:-1]], ends, strict=True):
                x, new = vectors[first:last], fresh[first:last]
                length = (x * x).sum(1)
                square = np.maximum(length[:, None] + length[None, :] - 2 * (x @ x.T), 0)
                good = base[None, first:last] & (new[:, None] | new[None, :]) & (square < bound[first:last, None])
                np.fill_diagonal(good, False)
                square[~good] = np.inf
                if len(x) > most:
                    near = np.argpartition(square, most - 1, axis=1)[:, :most]
                    row, place = np.nonzero(np.isfinite(np.take_along_axis(square, near, 1)))
                    other = near[row, place]
                else:
                    row, other = np.nonzero(np.isfinite(square))
                told.append(row + first)
                about.append(other + first)
                far.append(square[row, other])
            left, right = (pa.array(np.concatenate(i)) for i in (told, about))
            yield pa.RecordBatch.from_arrays([ids.take(left), ids.take(right), pa.array(np.concatenate(far))], ["id", "nid", "square"])

    return groups.mapInArrow(measure, f"id {id_type}, nid {id_type}, square double")


def _nearest(links: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` best links of each row; the limit is applied before the shuffle too."""
    best = Window.partitionBy("id").orderBy("square", "nid")
    return links.withColumn("_rank", F.row_number().over(best)).filter(c("_rank") <= degree).drop("_rank")


def _member(fresh: Column, bound: Column) -> Column:
    return F.struct("id", "vec", "base", fresh.alias("fresh"), bound.alias("bound"))


def _start(nodes: DataFrame, size: int, degree: int, seed: int, id_type: str) -> DataFrame:
    """Links inside blocks of about BLOCK rows; a code that many rows share is cut by hash."""
    found = []
    for s in range(STARTS):
        planes = max(1, min(62, math.ceil(math.log2(max(size, 2) / BLOCK)) + 1)) if size > BLOCK else 1
        coded = durable(_sides(nodes, planes, seed + s), "graph-codes")
        sizes = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("chunks"))
        dealt = coded.join(durable(sizes, "graph-sizes"), "code").withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(seed + s)), "chunks"))
        blocks = dealt.groupBy("code", "chunk").agg(F.collect_list(_member(F.lit(True), F.lit(math.inf))).alias("members"))
        found.append(_meetings(blocks.select("members"), degree, id_type))
    return union_sources(found).groupBy("id", "nid").agg(F.min("square").alias("square"))


def meetings_of(links: DataFrame, nodes: DataFrame, degree: int, seed: int = 42) -> DataFrame:
    """(at, id, fresh): the rows that each row ``at`` brings together: itself, its links, and up to ``degree`` links to it."""
    there = links.select(c("id").alias("at"), c("nid").alias("id"), "fresh")
    # A row that very many rows are linked to keeps some of them, fresh ones first.
    some = Window.partitionBy("at").orderBy(F.desc("fresh"), F.xxhash64("at", "id", F.lit(seed)))
    back = links.select(c("nid").alias("at"), "id", "fresh").withColumn("_rank", F.row_number().over(some))
    own = nodes.select(c("id").alias("at"), "id", F.lit(False).alias("fresh"))
    both = there.unionByName(back.filter(c("_rank") <= degree).drop("_rank")).unionByName(own)
    return both.groupBy("at", "id").agg(F.max("fresh").alias("fresh"))


def neighbor_graph(
    nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, least_change: float = LEAST_CHANGE, seed: int = 42
) -> NeighborGraph:
    """Refine links over a stored table (id, vec array<float>, base boolean); only rows with ``base`` are linked to.

    Ids are unique and vectors of one length. A table of one row, or none, has no links.
    """
    id_type = nodes.schema["id"].dataType.simpleString()
    size = nodes.count()
    if size < 2:
        empty = nodes.sparkSession.createDataFrame([], f"id {id_type}, nid {id_type}, square double")
        return NeighborGraph(empty)
    links = _nearest(_start(nodes, size, degree, seed, id_type), degree).withColumn("fresh", F.lit(True))
    links = durable(links, "graph")
    changed = []
    for number in range(rounds):
        told = links.groupBy("id").agg(F.when(F.count(F.lit(1)) >= degree, F.max("square")).alias("worst"))
        met = meetings_of(links, nodes, degree, seed + number)
        members = met.join(nodes, "id").join(told, "id", "left")
        member = _member(c("fresh"), F.coalesce("worst", F.lit(math.inf)))
        groups = members.groupBy("at").agg(F.collect_list(member).alias("members")).select("members")
        fresh = _meetings(groups, degree, id_type).withColumn("old", F.lit(0))
        known = links.select("id", "nid", "square", F.lit(1).alias("old"))
        merged = known.unionByName(fresh).groupBy("id", "nid").agg(F.min("square").alias("square"), (F.max("old") == 0).alias("fresh"))
        links = durable(_nearest(merged, degree), "graph")
        share = links.agg(F.avg(c("fresh").cast("int"))).first()[0] or 0.0
        changed.append(share)
        if share < least_change:
            break
    return NeighborGraph(links.select("id", "nid", "square"), changed)


def graph_join(
    queries: DataFrame,
    base: DataFrame,
    vec: str,
    k: int,
    query_key: str = "id",
    base_key: str = "id",
    exclude_self: bool = False,
    degree: int = DEGREE,
    rounds: int = ROUNDS,
    seed: int = 42,
) -> DataFrame:
    """(qid, bid, distance, rank) as by ``knn_join``, from a refined graph: some neighbours may be missed.

    ``neighbors.recall`` measures how many. Every query gets k rows, or all that there are: those of which the graph found
    fewer are searched exactly. Rows without a vector are left out. Keys are unique within each side; ``exclude_self``
    tells that a query is the base row of the same key.
    """
    degree = max(degree, 2 * k)
    sides = [base.select(F.struct(F.lit(0).alias("side"), c(base_key).alias("key")).alias("id"), c(vec).alias("vec"), F.lit(True).alias("base"))]
    asked = queries.select(c(query_key).alias("key"), c(vec).alias("vec"))
    side = 0
    if not (exclude_self and queries is base):
        side = 1
        sides.append(asked.select(F.struct(F.lit(1).alias("side"), "key").alias("id"), "vec", F.lit(False).alias("base")))
    nodes = union_sources([s.filter("vec is not null").withColumn("vec", c("vec").cast("array<float>")) for s in sides])
    graph = neighbor_graph(durable(nodes, "graph-nodes"), degree, rounds, seed=seed)
    links = graph.links.filter(F.col("id.side") == side).select(F.col("id.key").alias("qid"), F.col("nid.key").alias("bid"))
    if exclude_self:
        links = links.filter(c("qid") != c("bid"))
    links = durable(links, "graph-links")
    known = queries.filter(c(vec).isNotNull())
    counted = links.groupBy("qid").agg(F.count(F.lit(1)).alias("_n")).filter(c("_n") >= k)
    short = durable(known.join(counted, c(query_key) == c("qid"), "left_anti").select(c(query_key), c(vec)), "graph-short")
    if not short.isEmpty():
        exact = knn_join(short, base, vec, k, query_key, base_key, exclude_self)
        links = links.join(short, c("qid") == c(query_key), "left_anti").unionByName(exact.select("qid", "bid"))
    a = queries.select(c(query_key).alias("qid"), c(vec).cast("array<double>").alias("_a"))
    b = base.select(c(base_key).alias("bid"), c(vec).cast("array<double>").alias("_b"))
    gaps = F.zip_with("_a", "_b", lambda x, y: (x - y) * (x - y))
    measured = links.join(a, "qid").join(b, "bid").select("qid", "bid", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x)).alias("distance"))
    nearest = Window.partitionBy("qid").orderBy("distance", "bid")
    return measured.withColumn("rank", F.row_number().over(nearest)).filter(c("rank") <= k)
