"""Spark ML classifiers under familiar parameter names.

Regularisation strength C weighs the summed loss; Spark's regParam weighs the
penalty against the mean loss, so regParam = 1 / (C * rows).
"""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)


def reg_param(C: float, rows: int) -> float:
    return 1.0 / (C * max(rows, 1))


def linear_svc(rows: int, C: float = 1.0, weight: str | None = None, max_iter: int = 100) -> LinearSVC:
    """Hinge loss with an L2 penalty."""
    est = LinearSVC(regParam=reg_param(C, rows), maxIter=max_iter)
    return est.setWeightCol(weight) if weight else est


def logistic(
    rows: int, C: float = 1.0, penalty: str = "l2", weight: str | None = None, max_iter: int = 1000
) -> LogisticRegression:
    mix = {"l1": 1.0, "l2": 0.0}[penalty]
    est = LogisticRegression(regParam=reg_param(C, rows), elasticNetParam=mix, maxIter=max_iter)
    return est.setWeightCol(weight) if weight else est


def decision_tree(max_depth: int = 5, weight: str | None = None, seed: int = 42) -> DecisionTreeClassifier:
    est = DecisionTreeClassifier(maxDepth=max_depth, seed=seed)
    return est.setWeightCol(weight) if weight else est


def random_forest(
    n_estimators: int = 100, max_depth: int = 10, min_samples: int = 2, weight: str | None = None, seed: int = 42
) -> RandomForestClassifier:
    """``min_samples`` bounds leaf size, the nearest Spark has to a minimum split size."""
    est = RandomForestClassifier(
        numTrees=n_estimators, maxDepth=max_depth, minInstancesPerNode=max(1, min_samples // 2), seed=seed
    )
    return est.setWeightCol(weight) if weight else est


def gbt(
    n_estimators: int = 100,
    max_depth: int = 5,
    learning_rate: float = 0.1,
    subsample: float = 1.0,
    weight: str | None = None,
    seed: int = 42,
) -> GBTClassifier:
    est = GBTClassifier(maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, subsamplingRate=subsample, seed=seed)
    return est.setWeightCol(weight) if weight else est
