"""Recursive feature elimination by tree importance, sized by cross-validation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.ml.metrics import confusion
from trendspark.session import c, durable


def _slice(df: DataFrame, kept: list[int]) -> DataFrame:
    return VectorSlicer(inputCol="features", outputCol="_kept", indices=kept).transform(df)


def _fit(df: DataFrame, kept: list[int], max_depth: int, seed: int):
    tree = DecisionTreeClassifier(featuresCol="_kept", labelCol="label", maxDepth=max_depth, seed=seed)
    return tree.fit(_slice(df, kept))


def _f1(model, df: DataFrame, kept: list[int]) -> float:
    m = confusion(model.transform(_slice(df, kept)), "label", "prediction").first()
    denominator = 2 * m["tp"] + m["fp"] + m["fn"]
    return 2 * m["tp"] / denominator if denominator else 0.0


def _weakest(model, kept: list[int], drop: int) -> list[int]:
    """``kept`` without its ``drop`` least important members."""
    weights = model.featureImportances.toArray()
    order = sorted(range(len(kept)), key=lambda i: (weights[i], i))
    gone = set(order[:drop])
    return [k for i, k in enumerate(kept) if i not in gone]


def _eliminate(df: DataFrame, size: int, stop: int, step: int, max_depth: int, seed: int, test: DataFrame | None):
    """Drop features down to ``stop``; yields scores by feature count when ``test`` is given."""
    kept = list(range(size))
    scores: dict[int, float] = {}
    while True:
        if test is None and len(kept) <= stop:
            return kept, scores
        model = _fit(df, kept, max_depth, seed)
        if test is not None:
            scores[len(kept)] = _f1(model, test, kept)
        if len(kept) <= stop:
            return kept, scores
        kept = _weakest(model, kept, min(step, len(kept) - stop))


def rfecv(
    df: DataFrame, size: int, step: int = 1, folds: int = 5, max_depth: int = 5, seed: int = 42, parallelism: int = 4
) -> tuple[list[int], dict[int, float]]:
    """Selected feature positions and mean F1 by feature count.

    ``df`` holds features, label and fold. It is written once; each round is one
    distributed tree fit. Folds run side by side. Ties choose fewer features.
    """
    data = durable(df.select("features", c("label").cast("double").alias("label"), "fold"), "rfecv")

    def one(k: int) -> dict[int, float]:
        train, test = data.filter(F.col("fold") != k), data.filter(F.col("fold") == k)
        return _eliminate(train, size, 1, step, max_depth, seed, test)[1]

    with ThreadPoolExecutor(max_workers=min(parallelism, folds)) as pool:
        by_fold = list(pool.map(one, range(folds)))
    mean = {n: sum(s[n] for s in by_fold) / folds for n in by_fold[0]}
    best = min(mean, key=lambda n: (-mean[n], n))
    kept, _ = _eliminate(data, size, best, step, max_depth, seed, None)
    return kept, mean
