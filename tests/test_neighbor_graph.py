"""The neighbour graph: recall against all rows, bounded work, and the operators that can use it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendspark.catalog import core
from trendspark.ml.knn import knn_classify
from trendspark.operators import neighbor_graph, neighbors, resample
from trendspark.operators.neighbor_graph import graph_join
from trendspark.session import durable

SF = "/root/testdata/sf0.1"


def test_registered_graph_neighbours_keep_their_recall(spark):
    """Recall on the id % 100 queries against all rows."""
    vecs = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    matrix = np.array([v for _, v in vecs], dtype=np.float64)
    asked = [i for i, (key, _) in enumerate(vecs) if key % 100 == 0]
    best = neighbors.knn_brute(matrix[asked], matrix, 6)
    wanted = {(vecs[i][0], vecs[j][0]) for i, row in zip(asked, best, strict=True) for j in [j for j in row if j != i][:5]}
    rows = core.approximate_neighbors(spark, SF).collect()
    assert len(rows) == 5 * len(vecs)
    assert len(wanted & {(r["qid"], r["bid"]) for r in rows}) >= 0.9 * len(wanted)


def clustered(spark, n, dims=16, seed=3):
    centres = np.random.default_rng(1).normal(0, 3, (12, dims))
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 1, dims)], i % 12 % 2) for i in range(n)]
    return spark.createDataFrame(data, "id int, v array<double>, label int")


@pytest.mark.parametrize("n", [600, 2400])
def test_rows_meet_a_bounded_number_whatever_their_number(spark, n):
    df = clustered(spark, n)
    nodes = durable(df.select("id", F.col("v").cast("array<float>").alias("vec"), F.lit(True).alias("base")), "nodes")
    graph = neighbor_graph.neighbor_graph(nodes, degree=10)
    assert len(graph.changed) <= 8 and graph.changed == sorted(graph.changed, reverse=True)
    assert graph.links.groupBy("id").count().agg(F.max("count")).first()[0] <= 10
    met = neighbor_graph.meetings_of(graph.links.withColumn("fresh", F.lit(False)), nodes, 10)
    assert met.groupBy("at").count().agg(F.max("count")).first()[0] <= 2 * 10 + 1


def test_hub_rows_bring_a_bounded_number_together(spark):
    links = spark.range(1, 3000).select(F.col("id"), F.lit(0).cast("bigint").alias("nid"), F.lit(1.0).alias("square"), F.lit(True).alias("fresh"))
    nodes = spark.range(3000).select("id", F.array(F.lit(0.0)).alias("vec"), F.lit(True).alias("base"))
    sizes = {r["at"]: r["count"] for r in neighbor_graph.meetings_of(links, nodes, 7).groupBy("at").count().collect()}
    assert sizes[0] == 8 and max(sizes.values()) == 8


def test_queries_of_another_table(spark):
    base, queries = clustered(spark, 900), clustered(spark, 90, seed=4)
    exact = neighbors.knn_join(queries, base, "v", 5)
    found = graph_join(queries, base, "v", 5)
    assert found.count() == 450
    assert neighbors.recall(found, exact).first()["recall"] >= 0.9
    gaps = found.join(exact.select("qid", "bid", F.col("distance").alias("d")), ["qid", "bid"])
    assert gaps.filter(F.abs(F.col("distance") - F.col("d")) > 1e-9).count() == 0


def test_rows_without_links_are_searched_exactly(spark):
    # Copies of one row, a few far rows, one row without a vector.
    data = [(i, [1.0, 1.0]) for i in range(300)] + [(1000 + i, [50.0 * i, -3.0]) for i in range(1, 4)] + [(5000, None)]
    df = spark.createDataFrame(data, "id int, v array<double>")
    rows = graph_join(df, df, "v", 3, exclude_self=True).collect()
    assert len(rows) == 3 * 303 and all(r["qid"] != r["bid"] for r in rows)
    few = graph_join(df.filter("id in (0, 1)"), df.filter("id in (0, 1)"), "v", 3).collect()
    assert sorted((r["qid"], r["bid"]) for r in few) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert graph_join(df.limit(0), df, "v", 3).collect() == []
    assert graph_join(df, df.limit(0), "v", 3).collect() == []


def test_resampling_and_classification_by_the_graph(spark):
    df = clustered(spark, 600).withColumn("label", (F.col("id") % 12 < 3).cast("int"))
    grown = resample.smote(df, "v", "label", "id", search=graph_join)
    assert {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()} == {0: 450, 1: 450}
    plain = {(r["a"], r["b"]) for r in resample.tomek_pairs(df, "v", "label", "id").collect()}
    found = {(r["a"], r["b"]) for r in resample.tomek_pairs(df, "v", "label", "id", search=graph_join).collect()}
    assert len(plain & found) >= 0.9 * len(plain) and len(found - plain) <= 0.1 * len(plain) + 1
    ends = {i for pair in found for i in pair}
    gone = {r["id"] for r in df.collect() if r["id"] in ends and r["label"] == 0}
    assert {r["id"] for r in resample.tomek_links(df, "v", "label", "id", search=graph_join).collect()} == set(range(600)) - gone
    queries = clustered(spark, 60, seed=5).drop("label")
    exact = {r["id"]: r["prediction"] for r in knn_classify(df, queries, "v", "label", "id").collect()}
    near = {r["id"]: r["prediction"] for r in knn_classify(df, queries, "v", "label", "id", search=graph_join).collect()}
    assert sum(exact[i] == near[i] for i in exact) >= 57
