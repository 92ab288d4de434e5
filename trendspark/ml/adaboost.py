"""Boosted one-split trees.

Each round fits a Spark ML tree on weighted rows. The split is read back as two
numbers, so row weights stay a column expression; the table is rewritten to
shared storage every few rounds to keep that expression short.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.session import c, durable


@dataclass(frozen=True)
class Stump:
    feature: int
    threshold: float
    left: float
    right: float
    weight: float

    def predict(self, xs: Column) -> Column:
        return F.when(xs[self.feature] <= self.threshold, F.lit(self.left)).otherwise(F.lit(self.right))


@dataclass(frozen=True)
class AdaBoostModel:
    stumps: tuple[Stump, ...]

    def margin(self, xs: Column) -> Column:
        """Weighted vote for class 1 minus the vote for class 0."""
        total: Column = F.lit(0.0)
        for s in self.stumps:
            total = total + s.weight * (2 * s.predict(xs) - 1)
        return total

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        weight = sum(abs(s.weight) for s in self.stumps) or 1.0
        out = df.withColumn("_margin", self.margin(vector_to_array(c(features))))
        return (
            out.withColumn("prediction", F.when(c("_margin") > 0, 1.0).otherwise(0.0))
            .withColumn("probability", 1 / (1 + F.exp(-c("_margin") / weight)))
            .drop("_margin")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, s.feature, s.threshold, s.left, s.right, s.weight) for i, s in enumerate(self.stumps)]
        schema = "round int, feature int, threshold double, left double, right double, weight double"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> AdaBoostModel:
        rows = spark.read.parquet(path).orderBy("round").collect()
        return cls(tuple(Stump(r["feature"], r["threshold"], r["left"], r["right"], r["weight"]) for r in rows))


def _fit_stump(df: DataFrame, seed: int) -> tuple[int, float, float, float]:
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="_w", maxDepth=1, seed=seed)
    root = tree.fit(df)._java_obj.rootNode()
    if root.subtreeDepth() == 0:
        return 0, math.inf, root.prediction(), root.prediction()
    split = root.split()
    return split.featureIndex(), split.threshold(), root.leftChild().prediction(), root.rightChild().prediction()


def adaboost(
    train: DataFrame, rounds: int = 50, learning_rate: float = 1.0, seed: int = 42, rewrite_every: int = 10
) -> AdaBoostModel:
    """Fit on columns ``features`` (vector) and ``label`` (0/1)."""
    base = train.select("features", c("label").cast("double").alias("label"))
    df = durable(base.withColumn("_xs", vector_to_array("features")).withColumn("_w", F.lit(1.0)), "boost")
    stumps: list[Stump] = []
    for i in range(rounds):
        feature, threshold, left, right = _fit_stump(df, seed)
        guess = Stump(feature, threshold, left, right, 0.0).predict(c("_xs"))
        miss = guess != c("label")
        wrong, total = df.agg(F.sum(F.when(miss, c("_w")).otherwise(0.0)), F.sum("_w")).first()
        error = (wrong or 0.0) / total if total else 0.0
        if error <= 0:
            stumps.append(Stump(feature, threshold, left, right, 1.0))
            break
        if error >= 0.5:
            break
        alpha = learning_rate * math.log((1 - error) / error)
        stumps.append(Stump(feature, threshold, left, right, alpha))
        # Dividing by the total keeps weights in range; it does not change the fit.
        df = df.withColumn("_w", c("_w") * F.when(miss, F.lit(math.exp(alpha))).otherwise(1.0) / F.lit(total))
        if (i + 1) % rewrite_every == 0 and i + 1 < rounds:
            df = durable(df, "boost")
    return AdaBoostModel(tuple(stumps))
