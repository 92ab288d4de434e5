"""Model search. Folds follow key hashes, so no shuffle assigns them and runs repeat."""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.functions.hashing import hash_fraction_bucket, keyed_hash
from trendspark.ml.metrics import MacroF1Evaluator, binary_metrics
from trendspark.ml.naive_bayes import GaussianNB, Moments, class_moments
from trendspark.operators.prefix import running_totals
from trendspark.session import c

# Parameter grids of the standard searches.
GRIDS = {
    "gaussian_nb": {"var_smoothing": [1e-11, 1e-10, 1e-9, 1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3]},
    "knn": {"n_neighbors": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"]},
    "adaboost": {"n_estimators": [10, 50, 80, 100, 200], "learning_rate": [0.01, 0.05, 0.1, 0.5, 0.7, 1.0]},
    "linear_svc": {"C": [0.1, 1, 10]},
    "random_forest": {"n_estimators": [100, 200, 300], "max_depth": [5, 10, 15], "min_samples_split": [2, 5, 10]},
    "logistic": {"C": [0.01, 0.1, 1, 10], "penalty": ["l1", "l2"]},
}
# Ranges of the boosted-tree search and its number of trials.
GBT_SPACE = {
    "n_estimators": ("int", 100, 500),
    "max_depth": ("int", 3, 15),
    "learning_rate": ("log", 0.01, 0.3),
    "subsample": ("uniform", 0.6, 1.0),
}
GBT_TRIALS = 50


def with_folds(df: DataFrame, key: str, folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number from the key hash: balanced in expectation within every class, and map-only."""
    return df.withColumn(out, hash_fraction_bucket(key, seed, folds).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Exactly even folds per class: the hash rank within the class, modulo ``folds``. Costs a distributed sort."""
    marked = df.withColumn("_h", keyed_hash(key, seed))
    ranked = running_totals(marked, ["_h", key], {"_rank": F.lit(1).cast("bigint")}, by=[label])
    return ranked.withColumn(out, ((c("_rank") - 1) % folds).cast("int")).drop("_h", "_rank")


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values, strict=True)) for values in product(*grid.values())]


def param_maps(est: Estimator, settings: Sequence[Mapping[str, object]]) -> list[dict]:
    """Settings by Spark parameter name as Spark ML parameter maps."""
    return [{est.getParam(name): value for name, value in one.items()} for one in settings]


def grid_search(
    est: Estimator, settings: Sequence[Mapping[str, object]], train: DataFrame, folds: int = 5, parallelism: int = 4
) -> CrossValidatorModel:
    """Exhaustive cross-validation by macro F1. ``train`` holds features, label and fold."""
    search = CrossValidator(
        estimator=est,
        estimatorParamMaps=param_maps(est, settings),
        evaluator=MacroF1Evaluator(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    return search.fit(train)


def draw(space: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """``n`` settings from ranges ('int', lo, hi), ('uniform', lo, hi), ('log', lo, hi) or lists of choices."""
    rng = random.Random(seed)

    def one(spec: tuple | list) -> object:
        if isinstance(spec, list):
            return rng.choice(spec)
        kind, lo, hi = spec
        if kind == "int":
            return rng.randint(lo, hi)
        if kind == "log":
            return math.exp(rng.uniform(math.log(lo), math.log(hi)))
        return rng.uniform(lo, hi)

    return [{name: one(spec) for name, spec in space.items()} for _ in range(n)]


@dataclass(frozen=True)
class ValidatedSearch:
    """Settings with their macro F1 on the validation rows, and the best one's model."""

    settings: Sequence[dict]
    validationMetrics: Sequence[float]
    bestModel: Model


def random_search(
    est: Estimator,
    space: Mapping[str, tuple],
    n: int,
    train: DataFrame,
    folds: int | None = None,
    seed: int = 42,
    parallelism: int = 4,
    key: str = "key",
    val: DataFrame | None = None,
) -> CrossValidatorModel | ValidatedSearch:
    """``n`` drawn settings by macro F1: cross-validated over ``folds``, else on ``val``.

    Without ``val`` a quarter of the rows, by the hash of their key, is the validation part.
    """
    settings = draw(space, n, seed)
    if folds:
        return grid_search(est, settings, train, folds, parallelism)
    if val is None:
        part = hash_fraction_bucket(key, seed, 100)
        train, val = train.filter(part < 75), train.filter(part >= 75)
    scores: list[float] = []
    best: Model | None = None
    for one in param_maps(est, settings):
        model = est.fit(train, one)
        score = MacroF1Evaluator().evaluate(model.transform(val))
        if best is None or score > max(scores):
            best = model
        scores.append(score)
    return ValidatedSearch(settings, scores, best)


def search_models(
    settings: Sequence[Mapping[str, object]],
    train: DataFrame,
    fit: Callable[..., object],
    predict: Callable[[object, DataFrame], DataFrame],
    folds: int = 5,
) -> list[tuple[dict, float]]:
    """Cross-validated macro F1 of models outside Spark ML: ``fit(train, **setting)`` and ``predict(model, test)``."""
    out = []
    for setting in settings:
        scores = []
        for k in range(folds):
            model = fit(train.filter(c("fold") != k), **setting)
            scored = predict(model, train.filter(c("fold") == k))
            scores.append(float(binary_metrics(scored).first()["f1"]))
        out.append((dict(setting), sum(scores) / len(scores)))
    return out


def gaussian_nb_search(
    settings: Sequence[float], train: DataFrame, features: Sequence[str], folds: int = 5, label: str = "label"
) -> list[tuple[dict, float]]:
    """Cross-validated macro F1 of each ``var_smoothing`` in two scans, whatever the settings and folds.

    The moments by fold and class pool to the models that leave one fold out. One scan then scores every row by all
    models of its fold and counts hits in its task. Equal to ``search_models`` over ``GaussianNB``. A fold without rows
    counts as 0.
    """
    moments = class_moments(train, features, label, "fold")
    classes = sorted({y for _, y in moments})
    models: dict[int, list[GaussianNB]] = {}
    for k in range(folds):
        others = {y: [m for (f, z), m in moments.items() if z == y and f != k] for y in classes}
        pooled = {y: Moments.pooled(parts) for y, parts in others.items() if parts}
        if pooled:
            models[k] = [GaussianNB.of(pooled, features, one) for one in settings]
    schema = pa.schema([(n, pa.int64()) for n in ("setting", "fold", "label", "guess", "n")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: Counter = Counter()
        for batch in batches:
            fold, truth = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(fold), len(features))
            for k in set(fold.tolist()) & set(models):
                mine, real = x[fold == k], truth[fold == k]
                for i, model in enumerate(models[k]):
                    guess = model.predict(mine)
                    hits.update((i, k, y, g) for y, g in zip(real.tolist(), guess.tolist(), strict=True))
        rows = [(*key, n) for key, n in hits.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows, strict=True)], schema=schema)

    vector = F.array(*[c(n).cast("double") for n in features])
    rows = train.select(c("fold").cast("bigint"), c(label).cast("bigint"), vector.alias("vector"))
    found = rows.mapInArrow(score, ", ".join(f"{n} bigint" for n in schema.names)).groupBy("setting", "fold", "label", "guess").agg(F.sum("n"))
    cells: dict[tuple[int, int], dict[tuple[int, int], int]] = {}
    for i, k, y, g, n in found.collect():  # at most four a setting and fold
        cells.setdefault((i, k), {})[y, g] = n
    scores = [[macro_f1(cells.get((i, k), {})) for k in range(folds)] for i in range(len(settings))]
    return [({"var_smoothing": one}, sum(mine) / folds) for one, mine in zip(settings, scores, strict=True)]


def macro_f1(cells: Mapping[tuple[int, int], int]) -> float:
    """Mean F1 of the two classes from {(label, prediction): rows}, as by ``binary_metrics``."""
    parts = []
    for k in (0, 1):
        hit, miss = cells.get((k, k), 0), cells.get((k, 1 - k), 0) + cells.get((1 - k, k), 0)
        if hit + miss:
            parts.append(2 * hit / (2 * hit + miss))
    return sum(parts) / len(parts) if parts else 0.0


def best_setting(results: Sequence[tuple[dict, float]]) -> tuple[dict, float]:
    """Highest score; the earlier setting wins a tie."""
    best = results[0]
    for item in results[1:]:
        if item[1] > best[1]:
            best = item
    return best
