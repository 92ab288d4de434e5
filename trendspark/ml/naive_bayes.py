"""Gaussian naive Bayes with variance smoothing: one aggregate to fit, one projection to score.

Counts, means and variances by class are all that a model needs, and those of several parts of a table pool exactly. One
aggregate by fold and class therefore gives the models of every fold for every smoothing, and one more scan scores them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.session import c


@dataclass(frozen=True)
class Moments:
    """Rows of a part of one class, with the mean and the summed squared deviation of each feature."""

    n: int
    means: np.ndarray
    squares: np.ndarray

    @classmethod
    def pooled(cls, parts: Sequence[Moments]) -> Moments:
        n = sum(p.n for p in parts)
        means = sum(p.means * (p.n / n) for p in parts)
        return cls(n, means, sum(p.squares + p.n * (p.means - means) ** 2 for p in parts))


def class_moments(df: DataFrame, features: Sequence[str], label: str = "label", fold: str | None = None) -> dict[tuple[int, int], Moments]:
    """{(fold, class): moments} by one aggregate; all rows are of fold 0 without ``fold``.

    The driver gets one row per fold, class and feature.
    """
    part = c(fold).cast("int") if fold else F.lit(0)
    vector = F.array(*[c(n).cast("double") for n in features])
    long = df.select(c(label).cast("int").alias("_y"), part.alias("_f"), F.posexplode(vector).alias("_i", "_x"))
    rows = long.groupBy("_f", "_y", "_i").agg(F.count(F.lit(1)), F.avg("_x"), F.var_pop("_x")).collect()
    found: dict[tuple[int, int], Moments] = {}
    for f, y, i, n, mean, variance in rows:
        own = found.setdefault((f, y), Moments(n, np.full(len(features), np.nan), np.full(len(features), np.nan)))
        if mean is not None:
            own.means[i], own.squares[i] = mean, variance * n
    return found


@dataclass(frozen=True)
class GaussianNB:
    features: tuple[str, ...]
    classes: tuple[int, ...]
    priors: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    variances: tuple[tuple[float, ...], ...]

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], label: str = "label", var_smoothing: float = 1e-9) -> GaussianNB:
        """Class means and population variances; every variance grows by ``var_smoothing`` x the largest overall one."""
        return cls.of({y: m for (_, y), m in class_moments(df, features, label).items()}, features, var_smoothing)

    @classmethod
    def of(cls, moments: Mapping[int, Moments], features: Sequence[str], var_smoothing: float = 1e-9) -> GaussianNB:
        """The model of known moments by class."""
        classes = sorted(moments)
        whole = Moments.pooled([moments[y] for y in classes])
        floor = var_smoothing * float(np.nanmax(whole.squares / whole.n))
        return cls(
            tuple(features),
            tuple(classes),
            tuple(moments[y].n / whole.n for y in classes),
            tuple(tuple(moments[y].means.tolist()) for y in classes),
            tuple(tuple((moments[y].squares / moments[y].n + floor).tolist()) for y in classes),
        )

    def log_joint(self) -> list[Column]:
        """Log prior plus log likelihood, per class: a fold over the features, so that the plan does not grow with them."""
        vector = F.array(*[c(n).cast("double") for n in self.features])
        out = []
        for prior, means, variances in zip(self.priors, self.means, self.variances, strict=True):
            constant = math.log(prior) - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
            gaps = F.zip_with(vector, F.lit(list(means)), lambda x, m: x - m)
            terms = F.zip_with(gaps, F.lit([-0.5 / v for v in variances]), lambda d, w: d * d * w)
            out.append(F.aggregate(terms, F.lit(constant), lambda a, t: a + t))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Append prediction and, for two classes, the probability of the second."""
        scored = df.withColumn("_joint", F.array(*self.log_joint()))
        best = F.array_position("_joint", F.array_max("_joint")).cast("int")
        out = scored.withColumn("prediction", F.element_at(F.array(*[F.lit(k) for k in self.classes]), best).cast("double"))
        if len(self.classes) == 2:
            out = out.withColumn("probability", 1 / (1 + F.exp(c("_joint")[0] - c("_joint")[1])))
        return out.drop("_joint")

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Classes of the rows of a matrix; the smaller class wins a tie."""
        joint = []
        for prior, means, variances in zip(self.priors, self.means, self.variances, strict=True):
            spread = np.array(variances)
            constant = math.log(prior) - 0.5 * np.log(2 * math.pi * spread).sum()
            joint.append(constant - 0.5 * ((x - np.array(means)) ** 2 / spread).sum(axis=1))
        return np.array(self.classes)[np.argmax(joint, axis=0)] if len(x) else np.zeros(0, np.int64)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (list(self.features), k, p, list(m), list(v))
            for k, p, m, v in zip(self.classes, self.priors, self.means, self.variances, strict=True)
        ]
        schema = "features array<string>, class int, prior double, means array<double>, variances array<double>"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GaussianNB:
        rows = spark.read.parquet(path).orderBy("class").collect()
        return cls(
            tuple(rows[0]["features"]),
            tuple(r["class"] for r in rows),
            tuple(r["prior"] for r in rows),
            tuple(tuple(r["means"]) for r in rows),
            tuple(tuple(r["variances"]) for r in rows),
        )
