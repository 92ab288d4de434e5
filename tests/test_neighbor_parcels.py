"""Exact neighbours: what is written grows with the rows, not with the cells that they visit; results against all pairs."""

import gc
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendspark.llm.arrow import union_all
from trendspark.operators import neighbors, resample
from trendspark.session import durable


def bytes_on_disk(spark):
    """Shuffle files and tables of the shared folder."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shared = [os.path.join(d, f) for d, _, names in os.walk(spark.conf.get("spark.checkpoint.dir")) for f in names]
    return sum(blocks.apply(i).length() for i in range(blocks.size())) + sum(map(os.path.getsize, shared))


def written(spark, run):
    before = None
    for _ in range(10):  # files of earlier queries go a little later
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
        if before == (before := bytes_on_disk(spark)):
            break
    run().collect()
    return bytes_on_disk(spark) - before


def points(spark, n, dims=16, seed=2):
    data = np.random.default_rng(seed).normal(size=(n, dims))
    return spark.createDataFrame([(i, [float(x) for x in row], int(i % 4 == 0)) for i, row in enumerate(data)], "id int, v array<double>, y int")


def all_pairs(rows, k):
    """The k nearest of each key, ties by key, as the SQL twin finds them."""
    out = {}
    for qid, q in rows:
        far = sorted((float(np.sqrt(((np.array(b) - np.array(q)) ** 2).sum())), bid) for bid, b in rows if bid != qid)
        out.setdefault(qid, []).extend(far)
    return {qid: [bid for _, bid in sorted(far)[:k]] for qid, far in out.items()}


def nearest(df, k, **options):
    out = {}
    for r in neighbors.knn_join(df, df, "v", k, exclude_self=True, **options).orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["bid"])
    return out


def written_once(spark, run, times=8, n=1600):
    """At most ``times`` the room of the vectors; before, each was written for every cell and block that it met."""
    df = durable(points(spark, n), "points")
    assert written(spark, lambda: run(df)) < times * n * 16 * 8


def test_cells_do_not_multiply_what_is_written(spark):
    written_once(spark, lambda df: neighbors.knn_join(df, df, "v", 5, exclude_self=True, block_rows=16))


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_copies_repeated_keys_and_text_keys(spark, block):
    rng = np.random.default_rng(4)
    spots = rng.normal(size=(30, 5))
    # Very many copies of one vector, keys that come twice, alike or with another vector.
    rows = [(f"k{i:03d}", [float(x) for x in spots[0 if i % 2 else i % 30]]) for i in range(200)]
    rows += rows[:10] + [(f"k{i:03d}", [float(x) for x in rng.normal(size=5)]) for i in range(20, 30)]
    df = spark.createDataFrame(rows, "id string, v array<double>")
    assert nearest(df, 4, block_rows=block) == all_pairs(rows, 4)


@pytest.mark.parametrize("scale, offset", [(1e-18, 0.0), (1.0, 1e4), (1e20, 0.0), (1e-3, -7.0)])
def test_lengths_that_single_precision_does_not_tell_apart(spark, scale, offset):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(300, 6)) * scale + offset
    m[:100] += 50 * scale
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(m)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    assert nearest(df, 5, block_rows=100) == all_pairs(rows, 5)


def test_missing_keys_vectors_and_numbers(spark):
    rows = [(i if i % 5 else None, [float(i), 0.0]) for i in range(1, 60)] + [(100, None), (101, [float("nan"), 1.0]), (102, [None, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    found = neighbors.knn_join(df.filter("id is not null"), df, "v", 2, exclude_self=True, block_rows=16).collect()
    got = {(r["qid"], r["rank"]): r["bid"] for r in found}
    # A missing key comes first among ties and is no row's own.
    assert (got[1, 1], got[4, 1], got[4, 2], got[7, 1], got[7, 2]) == (2, None, 3, 6, 8)
    assert len(got) == 2 * len([i for i in range(1, 60) if i % 5])


def test_vectors_of_unequal_length_are_refused(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0]), (3, [2.0, 1.0, 1.0])], "id int, v array<double>")
    with pytest.raises(Exception, match="numbers expected|inhomogeneous"):
        neighbors.knn_join(df, df, "v", 1).collect()


def test_queries_without_a_base_and_a_base_without_queries(spark):
    df = points(spark, 20)
    assert neighbors.knn_join(df, df.limit(0), "v", 2).collect() == []
    assert neighbors.knn_join(df.limit(0), df, "v", 2).collect() == []
    only_nan = df.withColumn("v", F.array(F.lit(float("nan"))))
    assert neighbors.knn_join(only_nan, only_nan, "v", 2).collect() == []


@pytest.fixture
def small_blocks(monkeypatch):
    """Searches that name no block size get 64 rows instead of 4,096."""
    old = neighbors.knn_join.__defaults__
    monkeypatch.setattr(neighbors.knn_join, "__defaults__", tuple(64 if x == neighbors.BLOCK_ROWS else x for x in old))
    assert neighbors.knn_join.__defaults__ != old


def test_grown_classes_are_written_once(spark, small_blocks):
    written_once(spark, lambda df: resample.smote_tomek(df, "v", "y", "id").select("id"), times=16)


def test_neighbours_by_default_are_written_once(spark, small_blocks):
    written_once(spark, lambda df: neighbors.knn_join(df, df, "v", 5, exclude_self=True))


def test_pairs_are_written_once(spark, small_blocks):
    written_once(spark, lambda df: resample.tomek_pairs(df, "v", "y", "id"))


def test_modes_are_written_once(spark, small_blocks):
    def modes(df):
        return union_all([resample.resample(df, mode, "v", "y", "id").groupBy("y").count() for mode in ("over", "under", "smote", "tomek", "balanced")])

    written_once(spark, modes, times=12)


def test_links_are_written_once(spark, small_blocks):
    written_once(spark, lambda df: resample.tomek_links(df, "v", "y", "id").select("id"))
