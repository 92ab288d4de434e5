"""Train and compare classifiers on prepared splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.ml import estimators, search
from trendspark.ml.adaboost import adaboost
from trendspark.ml.knn import knn_classify
from trendspark.ml.metrics import classification_report
from trendspark.ml.naive_bayes import GaussianNB
from trendspark.ml.runs import run_experiment, save_model_version
from trendspark.ml.vectors import assemble, from_array
from trendspark.operators.resample import class_weights, resample
from trendspark.session import c, durable, scratch_path


@dataclass(frozen=True)
class KnnModel:
    """Training rows and settings; scoring is the neighbour join."""

    train: DataFrame
    n_neighbors: int
    weights: str

    def transform(self, df: DataFrame) -> DataFrame:
        votes = knn_classify(self.train, df, "vec", "label", "key", self.n_neighbors, self.weights)
        return df.join(votes.select("key", "prediction", "share"), "key").withColumn(
            "probability", F.when(c("prediction") == 1, c("share")).otherwise(1 - c("share"))
        )


@dataclass
class ModelTrainer:
    """Searches each model family, logs every run, keeps the best by macro F1.

    Inputs hold ``key``, ``target`` and numeric feature columns.
    """

    spark: SparkSession
    train: DataFrame
    val: DataFrame
    test: DataFrame
    key: str
    target: str
    features: Sequence[str]
    folds: int = 5
    runs_path: str = ""
    seed: int = 42
    best_model: object | None = None
    best_name: str | None = None
    best_f1: float = 0.0
    log: list[tuple[str, Mapping]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.runs_path = self.runs_path or scratch_path(self.spark, "runs")
        self.val, self.test = self._ready(self.val), self._ready(self.test)

    def _ready(self, df: DataFrame) -> DataFrame:
        """(key, label, vec, feature columns, features vector)."""
        cols = [c(n).cast("double").alias(n) for n in self.features]
        named = df.select(c(self.key).cast("string").alias("key"), c(self.target).cast("int").alias("label"), *cols)
        return assemble(named.withColumn("vec", F.array(*[c(n) for n in self.features])), self.features)

    def sampled(self, mode: str | None) -> DataFrame:
        """The rebalanced training part with folds, written once for all fits."""
        base = self._ready(self.train).select("key", "label", "vec")
        rows = resample(base, mode, "vec", "label", "key", self.seed)
        if mode == "over":
            # Copies need keys of their own: the key and the number of the copy, the same in every run.
            copy = F.row_number().over(Window.partitionBy("key").orderBy("label"))
            rows = rows.withColumn("key", F.concat_ws("#", "key", copy.cast("string")))
        rows = rows.select("key", "label", "vec", *[c("vec")[i].alias(n) for i, n in enumerate(self.features)])
        rows = class_weights(rows, "label")
        return durable(search.stratified_folds(from_array(rows, "vec"), "key", "label", self.folds, self.seed), "train")

    def _keep(self, name: str, metrics: Mapping, model: object) -> None:
        self.log.append((name, metrics))
        if metrics["f1"] > self.best_f1:
            self.best_f1, self.best_model, self.best_name = metrics["f1"], model, name

    def _own(self, name: str, mode: str | None, settings: Sequence[dict], fit, predict) -> Mapping:
        train = self.sampled(mode)
        return self._log_own(name, mode, train, search.search_models(settings, train, fit, predict, self.folds), fit)

    def _log_own(self, name: str, mode: str | None, train: DataFrame, results: Sequence[tuple[dict, float]], fit) -> Mapping:
        setting, cv = search.best_setting(results)
        model = fit(train, **setting)
        metrics, model = run_experiment(
            self.spark, f"{name} {mode or ''}".strip(), model, None, self.val, self.runs_path, setting, {"stage": "search"}, cv
        )
        self._keep(name, metrics, model)
        return metrics

    def _spark(self, name: str, mode: str | None, est, settings: Sequence[dict], train: DataFrame | None = None) -> Mapping:
        train = self.sampled(mode) if train is None else train
        found = search.grid_search(est, settings, train, self.folds)
        metrics, model = run_experiment(
            self.spark, f"{name} {mode or ''}".strip(), found, None, self.val, self.runs_path, None, {"stage": "search"}
        )
        self._keep(name, metrics, model)
        return metrics

    def _weight(self, mode: str | None) -> str | None:
        return "weight" if mode == "balanced" else None

    def train_gaussian_nb(self, mode: str | None = None, grid: Mapping = search.GRIDS["gaussian_nb"]) -> Mapping:
        def fit(df: DataFrame, var_smoothing: float) -> GaussianNB:
            return GaussianNB.fit(df, self.features, "label", var_smoothing)

        train = self.sampled(mode)
        results = search.gaussian_nb_search(grid["var_smoothing"], train, self.features, self.folds)
        return self._log_own("Gaussian NB", mode, train, results, fit)

    def train_knn(self, mode: str | None = None, grid: Mapping = search.GRIDS["knn"]) -> Mapping:
        def fit(df: DataFrame, n_neighbors: int, weights: str) -> KnnModel:
            return KnnModel(df.select("key", "vec", "label"), n_neighbors, weights)

        return self._own("KNN", mode, search.expand_grid(grid), fit, lambda m, df: m.transform(df))

    def train_ada(self, mode: str | None = None, grid: Mapping = search.GRIDS["adaboost"], trials: int = 15) -> Mapping:
        def fit(df: DataFrame, n_estimators: int, learning_rate: float):
            return adaboost(df, n_estimators, learning_rate, self.seed)

        settings = search.draw({k: list(v) for k, v in grid.items()}, trials, self.seed)
        return self._own("AdaBoost", mode, settings, fit, lambda m, df: m.transform(df))

    def train_svc(self, mode: str | None = None, grid: Mapping = search.GRIDS["linear_svc"]) -> Mapping:
        train = self.sampled(mode)
        rows = train.count()
        settings = [{"regParam": estimators.reg_param(s["C"], rows)} for s in search.expand_grid(grid)]
        return self._spark("LinearSVC", mode, estimators.linear_svc(rows, weight=self._weight(mode)), settings, train)

    def train_logistic_regression(self, mode: str | None = None, grid: Mapping = search.GRIDS["logistic"]) -> Mapping:
        train = self.sampled(mode)
        rows = train.count()
        mix = {"l1": 1.0, "l2": 0.0}
        settings = [
            {"regParam": estimators.reg_param(s["C"], rows), "elasticNetParam": mix[s["penalty"]]}
            for s in search.expand_grid(grid)
        ]
        return self._spark("Logistic Regression", mode, estimators.logistic(rows, weight=self._weight(mode)), settings, train)

    def train_random_forest(self, mode: str | None = None, grid: Mapping = search.GRIDS["random_forest"]) -> Mapping:
        settings = [
            {"numTrees": s["n_estimators"], "maxDepth": s["max_depth"], "minInstancesPerNode": max(1, s["min_samples_split"] // 2)}
            for s in search.expand_grid(grid)
        ]
        return self._spark("RandomForest", mode, estimators.random_forest(weight=self._weight(mode)), settings)

    def train_gbt(self, mode: str | None = None, space: Mapping = search.GBT_SPACE, trials: int = search.GBT_TRIALS) -> Mapping:
        """Drawn settings scored on the validation part; positives are weighted by the class ratio."""
        names = {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate"}
        train = self.sampled(mode)
        # The ratio of the classes as given, before any rebalancing.
        n, positives = self.train.agg(F.count(F.lit(1)), F.sum(c(self.target).cast("int"))).first()
        weighted = train.withColumn("weight", F.when(c("label") == 1, (n - positives) / positives).otherwise(1.0))
        drawn = {names[k]: v for k, v in space.items()}
        est = estimators.gbt(weight="weight", seed=self.seed)
        found = search.random_search(est, drawn, trials, weighted, seed=self.seed, val=self.val)
        best = search.best_setting(list(zip(found.settings, found.validationMetrics, strict=True)))
        model = found.bestModel
        metrics, model = run_experiment(
            self.spark, f"GBT {mode or ''}".strip(), model, None, self.val, self.runs_path, best[0], {"stage": "search"}, best[1]
        )
        self._keep("GBT", metrics, model)
        return metrics

    def test_report(self, model_dir: str | None = None) -> DataFrame | None:
        """Classification report of the best model on the test part; saved as a new version if a folder is given."""
        if self.best_model is None:
            return None
        if model_dir and not isinstance(self.best_model, KnnModel):
            save_model_version(self.spark, self.best_model, model_dir, self.best_name or "model")
        return classification_report(self.best_model.transform(self.test))
