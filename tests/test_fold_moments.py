"""Models from pooled moments against separate fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendspark.ml import search
from trendspark.ml.naive_bayes import GaussianNB, class_moments


def rows(spark, n=400):
    rng = np.random.default_rng(8)
    data = [(i, int(i % 3 == 0), float(rng.normal(i % 3 == 0, 1)), float(1e6 + rng.normal()), float(rng.exponential())) for i in range(n)]
    return search.with_folds(spark.createDataFrame(data, "key int, label int, a double, b double, c double"), "key", 4).repartition(3)


def test_pooled_moments_are_those_of_the_rows_together(spark):
    df = rows(spark)
    for fold in range(4):
        parts = class_moments(df.filter(F.col("fold") != fold), ["a", "b", "c"])
        model = GaussianNB.fit(df.filter(F.col("fold") != fold), ["a", "b", "c"], var_smoothing=1e-3)
        pdf = df.filter(F.col("fold") != fold).toPandas()
        floor = 1e-3 * max(pdf[n].var(ddof=0) for n in "abc")
        for y in (0, 1):
            mine = pdf[pdf["label"] == y]
            assert parts[0, y].n == len(mine)
            assert list(model.means[y]) == pytest.approx([mine[n].mean() for n in "abc"], rel=1e-12)
            assert list(model.variances[y]) == pytest.approx([mine[n].var(ddof=0) + floor for n in "abc"], rel=1e-9)


def test_grid_by_folds_equals_separate_fits(spark):
    df = rows(spark).cache()
    names = ["a", "b", "c"]
    grid = [1e-9, 1e-3, 1.0]
    want = search.search_models(
        [{"var_smoothing": s} for s in grid], df, lambda d, var_smoothing: GaussianNB.fit(d, names, "label", var_smoothing), lambda m, d: m.transform(d), 4
    )
    got = search.gaussian_nb_search(grid, df, names, 4)
    assert [s for s, _ in got] == [s for s, _ in want]
    assert [f for _, f in got] == pytest.approx([f for _, f in want], abs=1e-9)


def test_one_class_and_missing_folds(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0), (2, 0, 4.0)], "fold int, label int, a double")
    assert search.gaussian_nb_search([1e-3], df, ["a"], 4) == [({"var_smoothing": 1e-3}, 0.75)]
    assert search.gaussian_nb_search([1e-3], df.limit(0), ["a"], 2) == [({"var_smoothing": 1e-3}, 0.0)]


def test_model_scores_rows_as_in_memory(spark):
    df = rows(spark)
    model = GaussianNB.fit(df, ["a", "b", "c"], var_smoothing=1e-9)
    scored = model.transform(df).toPandas()
    assert scored["prediction"].astype(int).tolist() == model.predict(scored[["a", "b", "c"]].to_numpy()).tolist()
