"""k-nearest-neighbour classification over the neighbour join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.operators.neighbors import Search, knn_join
from trendspark.session import c


def knn_classify(
    train: DataFrame,
    queries: DataFrame,
    vec: str,
    label: str,
    key: str,
    k: int = 5,
    weights: str = "uniform",
    search: Search = knn_join,
) -> DataFrame:
    """(key, prediction, share): vote of the k nearest training rows.

    ``weights='distance'`` counts 1/distance; rows at distance 0 then decide alone.
    Ties go to the smaller class.
    """
    near = search(queries, train, vec, k, key, key)
    classes = train.select(c(key).alias("_bid"), c(label).cast("int").alias("_class"))
    votes = near.join(classes, c("bid") == c("_bid"))
    hit = c("distance") == 0
    if weights == "distance":
        by_class = votes.groupBy("qid", "_class").agg(
            F.count_if(hit).cast("double").alias("at_zero"), F.sum(F.when(~hit, 1 / c("distance"))).alias("inverse")
        )
        # Compare zero-distance votes first; only without any do inverse distances decide.
        vote = F.struct(c("at_zero"), F.coalesce("inverse", F.lit(0.0)), -c("_class"))
        exact = F.max("at_zero") > 0
        share = F.when(
            exact, F.max("at_zero") / F.sum("at_zero")
        ).otherwise(F.max(F.coalesce("inverse", F.lit(0.0))) / F.sum(F.coalesce("inverse", F.lit(0.0))))
    else:
        by_class = votes.groupBy("qid", "_class").agg(F.count(F.lit(1)).cast("double").alias("n"))
        vote = F.struct(c("n"), -c("_class"))
        share = F.max("n") / F.sum("n")
    return by_class.groupBy(c("qid").alias(key)).agg(
        F.max_by("_class", vote).cast("double").alias("prediction"), share.alias("share")
    )
