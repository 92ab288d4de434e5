"""Experiment records, model versions and batch scoring."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.ml.metrics import binary_metrics, roc_auc
from trendspark.session import c, durable
from trendspark.sources.readers import list_names

RUN_METRICS = ["accuracy", "f1", "precision", "recall", "roc_auc", "wasted_rate", "missed_rate"]
RUN_SCHEMA = (
    "run_id string, name string, params map<string,string>, tags map<string,string>, best_cv_score double, "
    + ", ".join(f"{m} double" for m in RUN_METRICS)
)


def score(model: object, df: DataFrame) -> DataFrame:
    """Append prediction, and positive-class probability where the model gives one."""
    out = model.transform(df)
    kind = out.schema["probability"].dataType if "probability" in out.columns else None
    if kind is None:
        return out.withColumn("probability", F.lit(None).cast("double"))
    return out if isinstance(kind, T.DoubleType) else out.withColumn("probability", vector_to_array("probability")[1])


def run_experiment(
    spark: SparkSession,
    name: str,
    est: Estimator | object,
    train: DataFrame | None,
    evaluation: DataFrame,
    runs_path: str,
    params: Mapping[str, object] | None = None,
    tags: Mapping[str, str] | None = None,
    best_cv_score: float | None = None,
) -> tuple[dict, object]:
    """Fit (skipped when ``train`` is None: ``est`` is then a model), score, append one run row."""
    model = est if train is None else est.fit(train)
    searched = getattr(model, "bestModel", None)
    if searched is not None:
        scores = getattr(model, "avgMetrics", None) or model.validationMetrics
        best_cv_score = float(max(scores))
        chosen = model.getEstimatorParamMaps()[list(scores).index(max(scores))]
        params = {p.name: v for p, v in chosen.items()} | dict(params or {})
        model = searched
    scored = durable(score(model, evaluation).select("label", "prediction", "probability"), "scored")
    metrics = binary_metrics(scored).first().asDict()
    known = scored.filter("probability is not null")
    metrics["roc_auc"] = roc_auc(known, "probability").first()[0]
    row = (
        uuid.uuid4().hex,
        name,
        {k: str(v) for k, v in (params or {}).items()},
        dict(tags or {}),
        best_cv_score,
        *[metrics[m] for m in RUN_METRICS],
    )
    record = spark.createDataFrame([row], RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
    record.coalesce(1).write.mode("append").parquet(runs_path)
    return metrics, model


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def best_run(runs: DataFrame, metric: str = "f1", order: str = "logged_at") -> DataFrame:
    """The run with the highest metric; the earliest wins a tie."""
    others = [n for n in runs.columns]
    top = runs.filter(c(metric).isNotNull()).orderBy(c(metric).desc(), c(order).asc()).limit(1)
    return top.select(*[c(n) for n in others])


def next_version(spark: SparkSession, folder: str, name: str) -> int:
    """One more than the highest existing version of ``name``."""
    stem = name.replace(" ", "_")
    found = [re.fullmatch(rf"{re.escape(stem)}_v(\d+)", n) for n in list_names(spark, folder)]
    return max((int(m.group(1)) for m in found if m), default=0) + 1


def save_model_version(spark: SparkSession, model: Model | object, folder: str, name: str) -> str:
    """Write under the next free ``name_vN`` and return the path."""
    path = f"{folder.rstrip('/')}/{name.replace(' ', '_')}_v{next_version(spark, folder, name)}"
    if hasattr(model, "write"):
        model.write().save(path)
    else:
        model.save(spark, path)
    return path


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names recorded in the vector's metadata, in order; empty if none."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    flat = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(flat, key=lambda a: a["idx"]) if "name" in a]


def score_batch(model: object, df: DataFrame, expected: Sequence[str] | None = None, features: str = "features") -> DataFrame:
    """Prediction, trend flag and probability (null if unsupported) for every row.

    With ``expected``, the feature names recorded in the vector must be these, in this order.
    """
    if expected is not None and (got := feature_names(df, features)) != list(expected):
        missing, extra = sorted(set(expected) - set(got)), sorted(set(got) - set(expected))
        raise ValueError(f"features do not match the model: missing {missing}, unknown {extra}, or in another order")
    scored = score(model, df)
    return scored.withColumn("prediction", c("prediction").cast("int")).withColumn("will_trend", c("prediction") == 1)
