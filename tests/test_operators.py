"""Table operators: semantics on fixtures, and the large-scale paths against plain computation."""

import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendspark.operators import (
    aggregates,
    checks,
    dedupe,
    distribution,
    encoding,
    expectations,
    filters,
    joins,
    neighbors,
    prefix,
    projection,
    quantiles,
    ranking,
    resample,
    sampling,
    transforms,
)
from trendspark.session import c


# --- projection, filters, joins ---------------------------------------------------------


def test_align_columns(spark):
    df = spark.createDataFrame([("x", 2, 3.5)], "gone string, kept int, `dotted.name` double")
    wanted = spark.createDataFrame([], "`dotted.name` double, added date, kept int").schema
    out = projection.align_columns(df, wanted)
    assert out.schema.simpleString() == wanted.simpleString() and out.first()["added"] is None and out.first()["kept"] == 2


def test_drop_columns_takes_dotted_names_exactly(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c"])
    assert projection.drop_columns(df, ["a.b", "missing"]).columns == ["c"]


def test_embedding_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "title_emb int, embeddable int, x int")
    assert projection.embedding_columns(df) == ["title_emb"]


@pytest.mark.parametrize(
    ("likes", "views", "count", "disabled", "kept"),
    [
        ("999", "1", "0", "False", False),
        ("10", "1000", "5", "True", False),
        ("10", "1000", "0", "True", True),
        ("10", "1000", None, "False", True),
        ("10", "1000", None, "True", True),
        ("bad", "0", "1", None, True),
        ("10", "1000", "-1", "False", False),
    ],
)
def test_invalid_rows(spark, likes, views, count, disabled, kept):
    df = spark.createDataFrame([(likes, views, count, disabled)], "likes string, view_count string, comment_count string, comments_disabled string")
    out = filters.filter_comment_state(filters.filter_le(df, "likes", "view_count"), "comment_count", "comments_disabled")
    assert (out.count() == 1) is kept


def test_drop_nulls_also_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, y string")
    assert filters.drop_nulls(df).count() == 1


def test_violations(spark):
    df = spark.createDataFrame([(100, 10, True, 5), (10, 50, False, 5), (10, 1, True, 0)], "view_count int, likes int, comments_disabled boolean, comment_count int")
    got = {r["rule"]: r["violations"] for r in filters.violations(df).collect()}
    assert got == {"disabled_with_comments": 1, "likes_above_views": 1}


def test_null_count_with_disabled_comments_is_a_violation(spark):
    df = spark.createDataFrame([("True", None)], "comments_disabled string, comment_count int")
    assert filters.violations(df).first()["violations"] == 1
    strict = filters.violations(df, filters.video_rules(df, strict_types=True))
    assert strict.first()["violations"] == 0


def test_merge_scraped_right_side_wins(spark):
    base = spark.createDataFrame([("v1", False), ("v2", True)], "video_id string, comments_disabled boolean")
    scraped = spark.createDataFrame([("v1", True)], "video_id string, comments_disabled boolean")
    out = joins.merge_scraped(base, scraped, "video_id", ["comments_disabled"])
    assert dict(map(tuple, out.collect())) == {"v1": True, "v2": True}
    assert out.columns == ["video_id", "comments_disabled"]


# --- de-duplication and running totals ----------------------------------------------------


def test_dedupe_key_keeps_first_and_survives_a_hot_key(spark):
    df = spark.range(30000).select((F.col("id") % 3 * (F.col("id") % 7)).alias("k"), F.col("id"), F.lit(None).cast("string").alias("n"))
    out = dedupe.dedupe_key(df, "k", ["id"])
    want = df.groupBy("k").agg(F.min("id"))
    assert sorted((r["k"], r["id"]) for r in out.collect()) == sorted(tuple(r) for r in want.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_union_sources_checks_columns(spark):
    with pytest.raises(ValueError, match="column sets differ"):
        dedupe.union_sources([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int")])


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_totals(spark, partitions):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 500, p=[0.8, 0.1, 0.1]), "v": rng.permutation(500), "w": rng.integers(0, 9, 500)})
    df = spark.createDataFrame(pdf)
    out = prefix.running_totals(df, ["v"], {"cum": c("w"), "nth": F.lit(1)}, by=["g"], grand={"cum": "all"}, partitions=partitions)
    got = out.toPandas().sort_values("v").reset_index(drop=True)
    want = pdf.sort_values("v").reset_index(drop=True)
    by = want.groupby("g", dropna=False)["w"]
    assert (got["cum"].to_numpy() == by.cumsum().to_numpy()).all()
    assert (got["all"].to_numpy() == by.transform("sum").to_numpy()).all()
    assert (got["nth"].to_numpy() == want.groupby("g", dropna=False).cumcount().to_numpy() + 1).all()


# --- quantiles ----------------------------------------------------------------------------


@pytest.mark.parametrize("path", ["values", "brackets", "missed brackets", "histogram"])
@pytest.mark.parametrize("shape", ["uniform", "hot value", "heavy tail", "few values"])
def test_quantiles(spark, path, shape):
    rng = np.random.default_rng(7)
    n = 60_000
    x = {
        "uniform": lambda: rng.random(n),
        "hot value": lambda: np.where(rng.random(n) < 0.4, 0.5, rng.random(n)),
        "heavy tail": lambda: np.exp(rng.normal(0, 5, n)),
        "few values": lambda: rng.integers(0, 5, n).astype(float),
    }[shape]()
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"x": x})).unionByName(spark.createDataFrame([(None,), (float("nan"),)], "x double"))
    if path == "histogram":
        out = quantiles.value_quantiles(df, ["x"], probs)
    elif path == "values":
        out = quantiles.quantiles(df, ["x"], probs, small_rows=10**9)
    else:
        out = quantiles.quantiles(df, ["x"], probs, accuracy=1000 if path == "brackets" else 10**8, small_rows=0)
    row = out.first()
    assert row["n"] == n
    assert row["q"] == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12)


@pytest.mark.parametrize("groups", [3, 60])
def test_quantiles_by_group(spark, groups):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, groups, 20_000), "x": rng.normal(size=20_000)})
    pdf.loc[:7000, "g"] = 0
    df = spark.createDataFrame(pdf)
    for small in (0, 10**9):
        out = quantiles.quantiles(df, ["x"], [0.25, 0.5], by=["g"], accuracy=200, small_rows=small)
        got = {r["g"]: r["q"] for r in out.collect()}
        want = pdf.groupby("g")["x"].quantile([0.25, 0.5]).unstack()
        assert len(got) == groups
        for g, q in got.items():
            assert q == pytest.approx(want.loc[g].tolist(), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=40), st.floats(0, 1))
def test_quantiles_property(spark, items, p):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in items], "x double").coalesce(2)
    known = [v for v in items if v is not None]
    got = quantiles.quantiles(df, ["x"], [p], small_rows=0).first()["q"]
    if known:
        assert got[0] == pytest.approx(float(np.quantile(known, p)), abs=1e-9)
    else:
        assert got is None or got[0] is None


# --- statistics -----------------------------------------------------------------------------


def test_spearman_and_ranks_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.integers(0, 20, 400).astype(float), "b": rng.normal(size=400)})
    pdf["c"] = pdf["a"] * 2 + rng.integers(0, 9, 400)
    pdf.loc[::11, "c"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = {(r["a"], r["b"]): r["r"] for r in distribution.spearman(df, ["a", "b", "c"]).collect()}
    for (x, y), r in got.items():
        both = pdf[[x, y]].dropna().rank()
        assert r == pytest.approx(both[x].corr(both[y]), abs=1e-12)
    ranks = distribution.average_rank(df.select("a"), "a").toPandas()
    assert (ranks.sort_values("a")["avg_rank"].to_numpy() == np.sort(pdf["a"].rank().to_numpy())).all()


def test_skew_and_std_match_pandas(spark):
    s = pd.Series([1, 2, 3, 4, 5, 1000])
    df = spark.createDataFrame([(float(v),) for v in s], "x double")
    assert distribution.skew(df, ["x"]).first()["skew"] == pytest.approx(s.skew())
    lo, hi = distribution.fences(df, ["x"], "iqr")["x"]
    assert (lo, hi) == (2.25 - 1.5 * 2.5, 4.75 + 1.5 * 2.5)
    assert distribution.fences(df, ["x"], "zscore", z=1)["x"][1] == pytest.approx(s.mean() + s.std())


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(2).normal(size=3000)
    out = distribution.histogram(spark.createDataFrame(pd.DataFrame({"x": x})), "x", 20).orderBy("bin").toPandas()
    want, edges = np.histogram(x, 20)
    assert out["n"].tolist() == want.tolist()
    assert out["lo"].tolist() == pytest.approx(edges[:-1].tolist())


def test_kde_is_a_density(spark):
    x = np.random.default_rng(2).normal(size=4000)
    out = distribution.kde_grid(spark.createDataFrame(pd.DataFrame({"g": 1, "x": x})), "g", "x").orderBy("point").toPandas()
    assert np.trapezoid(out["density"], out["at"]) == pytest.approx(1.0, abs=0.01)


def test_lorenz_and_top_share(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 3), ("d", 1)], "k string, v int")
    out = ranking.lorenz(df, "k", "v").orderBy("rank").collect()
    assert [r["k"] for r in out] == ["b", "c", "a", "d"]
    assert [r["cum_pct_value"] for r in out] == [50.0, 80.0, 90.0, 100.0]
    top = ranking.top_share(df, "k", "v", 0.5).first()
    assert (top["top_keys"], top["share_pct"]) == (2, 80.0)


def test_value_shares_leave_nulls_out(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "x int")
    got = {r["value"]: r["share"] for r in aggregates.value_shares(df, "x").collect()}
    assert got == {1: 2 / 3, 0: 1 / 3}


def test_unknown_groups_are_left_out(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "g string, y int")
    assert [tuple(r) for r in aggregates.target_rate(df, "g", "y").collect()] == [("a", 0.5, 2)]
    assert aggregates.group_median(df, "g", ["y"]).count() == 1
    assert distribution.box_stats(df, "g", ["y"]).count() == 1


# --- transforms -----------------------------------------------------------------------------


def test_log_transform(spark):
    df = spark.createDataFrame([(-5.0, 1.0, 9.0, None)], "a double, b double, c double, d double")
    out = transforms.log_transform(df, ["a", "d", "missing"])
    out = transforms.log_transform(transforms.log_transform(out, ["b"], "log2"), ["c"], "log10").first()
    assert tuple(out) == (0.0, 1.0, 1.0, None)


def test_cap_outliers(spark):
    df = spark.createDataFrame([(v, n) for v, n in zip([1, 2, 3, 4, 5, 1000], [0, 5, 100, 1, 2, -3], strict=True)], "view_count int, chapter_count int")
    out = transforms.cap_outliers(df, ["view_count", "chapter_count", "missing"], "iqr").agg(F.max("view_count"), F.max("chapter_count"), F.min("chapter_count")).first()
    assert tuple(out) == (8.5, 20, 0)
    assert transforms.cap_outliers(df, ["view_count"], "other").agg(F.max("view_count")).first()[0] == 1000


def test_cast_types(spark):
    df = spark.createDataFrame([("10", "True"), ("20.0", "false"), ("invalid", "TRUE")], "view_count string, embeddable string")
    got = [tuple(r) for r in transforms.cast_types(df, ["view_count", "likes"], ["embeddable"]).collect()]
    assert got == [(10, True), (20, False), (None, True)]


def test_robust_scale_keeps_other_columns(spark):
    df = spark.createDataFrame([(10, 1, 0.5, 0.1), (20, 0, 0.6, 0.2), (30, 1, 0.7, 0.3)], "view_count int, is_trending int, lang_base double, pca_0 double")
    cols = transforms.scalable_columns(df, "is_trending", ["lang_base"])
    assert cols == ["view_count"]
    out = transforms.RobustScale.fit(df, cols).apply(df).orderBy("pca_0").collect()
    assert [r["view_count"] for r in out] == [-1.0, 0.0, 1.0]
    assert [r["lang_base"] for r in out] == [0.5, 0.6, 0.7]


def test_rare_groups_and_frequencies(spark):
    df = spark.createDataFrame([("en",)] * 8 + [("fr",), (None,)], "lang string")
    assert encoding.group_rare_share(df, "lang", 0.2).filter("lang = 'other'").count() == 1
    enc = encoding.FrequencyEncoding.fit(df, ["lang"])
    test = spark.createDataFrame([("en",), ("xx",), (None,)], "lang string")
    assert sorted((r[0] is None, r[0]) for r in enc.apply(test).collect())[0] == (False, 8 / 9)
    assert enc.apply(test).filter("lang is null").count() == 2


# --- sampling and rebalancing -------------------------------------------------------------------


def test_sample_by_prefix_equals_sort(spark, monkeypatch):
    df = spark.range(20_000).withColumn("x", F.col("id") * 2)
    want = {r["id"] for r in sampling.sample_n(df, 7777, "id").collect()}
    monkeypatch.setattr(sampling, "_CELL_ROWS", 3)
    got = [r["id"] for r in sampling.sample_n(df, 7777, "id").collect()]
    assert len(got) == 7777 and set(got) == want
    assert sampling.sample_n(df, 50_000, "id").count() == 20_000


def test_sample_of_one_hot_key_is_exact(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_CELL_ROWS", 3)
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"), "id")
    assert sampling.sample_n(df, 3500, "k").count() == 3500
    assert sampling.sample_n(df, 100, "k").count() == 100


def test_split_is_disjoint_and_independent_of_partitioning(spark):
    df = spark.range(5000)
    parts = [{r["id"] for r in p.collect()} for p in sampling.split3(df, "id")]
    again = [{r["id"] for r in p.collect()} for p in sampling.split3(df.repartition(1), "id")]
    assert parts == again
    assert sum(map(len, parts)) == 5000 and not parts[0] & parts[1] and not parts[1] & parts[2]
    assert 0.57 < len(parts[0]) / 5000 < 0.63


def test_over_and_under_sample(spark):
    df = spark.range(100).withColumn("y", (F.col("id") < 23).cast("int"))
    grown = {r["y"]: r["count"] for r in resample.over_sample(df, "y", "id").groupBy("y").count().collect()}
    cut = {r["y"]: r["count"] for r in resample.under_sample(df, "y", "id").groupBy("y").count().collect()}
    assert grown == {0: 77, 1: 77} and cut == {0: 23, 1: 23}


@pytest.mark.parametrize("block", [16, 100_000])
def test_knn_join_matches_brute_force(spark, block):
    rng = np.random.default_rng(11)
    # A third of all base rows are one point.
    base = np.vstack([rng.normal(size=(200, 6)), np.tile(rng.normal(size=(1, 6)), (100, 1))])
    q = np.vstack([rng.normal(size=(40, 6)), base[-1:]])

    def frame(m):
        return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id int, v array<double>")

    out = neighbors.knn_join(frame(q), frame(base), "v", 4, block_rows=block)
    got = {}
    for r in out.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["bid"])
    assert got == dict(enumerate(neighbors.knn_brute(q, base, 4)))


def test_knn_join_skips_itself_and_handles_small_bases(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "id int, v array<double>")
    out = neighbors.knn_join(df, df, "v", 1, exclude_self=True).orderBy("qid").collect()
    assert [(r["qid"], r["bid"]) for r in out] == [(1, 2), (2, 1), (3, 2)]
    assert neighbors.knn_join(df, df, "v", 10, exclude_self=True).count() == 6


def test_smote_balances_on_segments(spark):
    rng = np.random.default_rng(4)
    data = [(i, int(i < 20), [float(x) for x in rng.normal(size=3)]) for i in range(100)]
    df = spark.createDataFrame(data, "id int, y int, v array<double>")
    out = resample.smote(df, "v", "y", "id")
    sizes = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert sizes == {0: 80, 1: 80}
    minority = np.array([v for _, y, v in data if y == 1])
    made = np.array([r["v"] for r in out.filter("id like 'smote-%'").collect()])
    assert (made >= minority.min(0) - 1e-9).all() and (made <= minority.max(0) + 1e-9).all()
    assert out.select("id").distinct().count() == 160


def test_tomek_links(spark):
    df = spark.createDataFrame([(1, 0, [0.0]), (2, 1, [0.1]), (3, 0, [5.0]), (4, 0, [5.1]), (5, 0, [9.0])], "id int, y int, v array<double>")
    assert {r["id"] for r in resample.tomek_links(df, "v", "y", "id").collect()} == {2, 3, 4, 5}
    assert {r["id"] for r in resample.tomek_links(df, "v", "y", "id", "all").collect()} == {3, 4, 5}
    assert resample.resample(df, "balanced", "v", "y", "id") is df


# --- validation -----------------------------------------------------------------------------------


def first(df):
    return df.first()


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert checks.check_language(df, "lang", spark.createDataFrame([("en",)], "code string")).first()["passed"] is False
    assert checks.check_date_order(df, "a", "b").first()["passed"] is True
    assert checks.check_dominance(df, "a").first()["detail"] == "column not found"
    assert checks.check_imbalance(df, "a").first()["detail"] == "column not found"
    assert checks.check_count_matches(df, "a", "b").first()["detail"] == "column not found"


def test_outlier_checks(spark):
    df = spark.createDataFrame([(v, 5) for v in (1, 2, 3, 4, 5, 6, 10000)], "x int, same int")
    got = {r["column"]: (r["passed"], r["issue_count"]) for r in checks.check_outliers_iqr(df, ["x", "same"]).collect()}
    assert got == {"x": (False, 1), "same": (True, 0)}
    got = {r["column"]: r["passed"] for r in checks.check_outliers_z(df, ["x", "same"], 2.0).collect()}
    assert got == {"x": False, "same": True}


def test_imbalance(spark):
    def run(values):
        return checks.check_imbalance(spark.createDataFrame([(v,) for v in values], "y int"), "y").first()

    assert run([1] * 95 + [0] * 5)["passed"] is False
    assert run([1, 0] * 5)["passed"] is True
    assert run([0, 1, 2])["detail"] == "non-binary values"


def test_correlation_and_variance(spark):
    df = spark.createDataFrame([(i, 2 * i, i % 3, 7) for i in range(10)], "a int, b int, c int, d int")
    got = {r["column"]: r["passed"] for r in checks.check_correlation(df, ["a", "b", "c"], 0.7).collect()}
    assert got == {"a,b": False, "a,c": True, "b,c": True}
    got = {r["column"]: r["passed"] for r in checks.check_variance(df, ["a", "d"]).collect()}
    assert got == {"a": True, "d": False}


def test_count_matches(spark):
    df = spark.createDataFrame([(2, "[{'t': 1}, {'t': 2}]"), (0, "[]"), (None, None), (3, "[{'t': 1}]"), (1, "[oops")], "n int, l string")
    row = checks.check_count_matches(df, "n", "l").first()
    assert (row["passed"], row["detail"]) == (False, "unparseable=1, mismatch=1")


def test_future_and_order(spark):
    df = spark.createDataFrame([("2024-01-02T00:00:00Z", "2024-01-01"), ("2024-01-01T00:00:00Z", "2024-01-05"), ("x", None)], "a string, b string")
    row = checks.date_order(df, "a", "b").first()
    assert tuple(row) == (1, 1, 1)
    assert checks.future_counts(df, ["a"], datetime(2024, 1, 1, 12)).first()["future"] == 1


def test_suite_and_scorecard(spark):
    df = spark.createDataFrame([(1, "2d"), (1, "4d"), (None, None), (50, "5d")], "categoryId int, dimension string")
    out = expectations.run_suite(df, [*expectations.not_null("categoryId"), expectations.between("categoryId", 1, 44), expectations.in_set("dimension", ["2d", "3d"]), expectations.unique("categoryId")])
    got = {r["check"]: (r["unexpected_count"], r["sample"]) for r in out.collect()}
    assert got == {"not_null": (1, None), "between": (1, "50"), "in_set": (2, "4d, 5d"), "unique": (2, None)}
    assert expectations.suite_passed(out).first()["passed"] is False
    card = {r["dimension"]: (r["passed"], r["total"]) for r in checks.scorecard(out.withColumnRenamed("unexpected_count", "issue_count")).collect()}
    assert card["TOTAL"] == (0, 4)


def test_checks_share_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    probes = [*checks.variance_probes(df, ["l_tax", "l_discount"]), *checks.skew_probes(df, ["l_tax"]), *checks.blank_probes(df, ["l_returnflag"])]
    from trendspark.operators.probes import evaluate

    plan = evaluate(df, probes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    plan = filters.filter_iqr(df, "l_extendedprice", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_extendedprice" in plan and "l_shipdate" not in plan.split("ReadSchema")[-1]


def test_math_is_plain():
    assert math.isclose(neighbors._distances(np.array([[0.0, 3.0]]), np.array([[4.0, 0.0]]))[0, 0], 5.0)


# --- NaN is missing ----------------------------------------------------------------------


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (nan, 5.0), (3.0, 6.0), (4.0, nan)], "x double, y double")
    row = aggregates.numeric_summary(df, ["x"]).first()
    assert (row["n"], row["min"], row["max"]) == (3, 1.0, 4.0) and row["mean"] == pytest.approx(8 / 3)
    assert [r["n"] for r in distribution.histogram(df, "x", 3).orderBy("bin").collect()] == [1, 0, 2]
    assert distribution.pearson(df, ["x", "y"]).first()["r"] == pytest.approx(1.0)
    assert distribution.skew(df, ["x"]).first()["skew"] == pytest.approx(pd.Series([1.0, 3.0, 4.0]).skew())
    assert not any(math.isnan(v) for v in distribution.fences(df, ["x"], "zscore")["x"])
    scores = [r["x_z"] for r in transforms.zscore(df, ["x"]).collect()]
    assert scores[1] is None and scores[0] == pytest.approx((1 - 8 / 3) / np.std([1, 3, 4], ddof=1))
    wild = spark.createDataFrame([(float(i),) for i in range(50)] + [(1e9,), (nan,)], "x double")
    assert not checks.check_outliers_z(wild, ["x"]).first()["passed"]
    assert checks.check_outliers_z(wild, ["x"]).first()["issue_count"] == 1


def test_rules_compare_text_as_numbers(spark):
    df = spark.createDataFrame([("9", "10", "0", "true"), ("11", "10", "bad", "true")], "likes string, view_count string, comment_count string, comments_disabled string")
    got = {r["rule"]: r["violations"] for r in filters.violations(df).collect()}
    assert got == {"disabled_with_comments": 1, "likes_above_views": 1}


def test_fill_when_takes_the_column_type(spark):
    df = spark.createDataFrame([("abc",), (None,)], "t string")
    assert [r["t"] for r in transforms.fill_when(df, "t", F.lit(True), 0).collect()] == ["abc", "0"]


def test_quick_summary_reports_every_column(spark):
    df = spark.createDataFrame([tuple([None, *range(14)])], "t int, " + ", ".join(f"c{i} int" for i in range(14)))
    rows = checks.quick_summary(df.union(df), "t").filter("section = 'numeric'").select("name").distinct()
    assert rows.count() == 15


def test_approximate_neighbours_keep_their_recall(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 4, (20, 16))
    data = [(i, [float(x) for x in centres[i % 20] + rng.normal(0, 1, 16)]) for i in range(1200)]
    df = spark.createDataFrame(data, "id int, v array<double>")
    exact = neighbors.knn_join(df, df, "v", 5, exclude_self=True, block_rows=64).cache()
    found = neighbors.knn_join(df, df, "v", 5, exclude_self=True, block_rows=64, probes=4)
    assert neighbors.recall(found, exact).first()["recall"] >= 0.9
    assert neighbors.recall(exact, exact).first()["recall"] == 1.0
    matrix = np.array([v for _, v in data])
    np.fill_diagonal(d := np.sqrt(((matrix[:, None] - matrix[None]) ** 2).sum(2)), np.inf)
    best = np.sort(d, axis=1)[:, :5]
    got = {(r["qid"], r["rank"]): r["distance"] for r in exact.collect()}
    assert all(got[i, k + 1] == pytest.approx(best[i, k]) for i in range(1200) for k in range(5))


@pytest.mark.parametrize("cells", [24, 256])
def test_a_share_of_the_cells_keeps_recall(spark, monkeypatch, cells):
    sf = "/root/testdata/sf0.1"
    vecs = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    matrix = np.array([v for _, v in vecs], dtype=np.float64)
    best = neighbors.knn_brute(matrix[::20], matrix, 6)
    wanted = {(vecs[20 * i][0], vecs[j][0]) for i, row in enumerate(best) for j in [j for j in row if j != 20 * i][:5]}
    monkeypatch.setattr(neighbors, "_cells", lambda size, block_rows: cells)
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    near = neighbors.knn_join(table, table, "embedding", 5, "vec_id", "vec_id", exclude_self=True, probe_share=0.75)
    found = {(r["qid"], r["bid"]) for r in near.collect()}
    assert len(wanted & found) >= 0.9 * len(wanted)


def test_neighbours_among_many_ties(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 0.0]) for i in range(90)], "id int, v array<double>")
    rows = neighbors.knn_join(df, df, "v", 4, exclude_self=True, block_rows=16).collect()
    for i in range(90):
        want = [j for j in range(90) if j % 3 == i % 3 and j != i][:4]
        assert [r["bid"] for r in sorted(rows, key=lambda r: r["rank"]) if r["qid"] == i] == want


def test_spearman_with_and_without_gaps(spark):
    rng = np.random.default_rng(4)
    table = pd.DataFrame({"a": rng.integers(0, 9, 300), "b": rng.normal(size=300), "c": rng.integers(0, 50, 300), "d": rng.normal(size=300)}).astype(float)
    table["c"] += table["a"]
    table.loc[::7, "d"] = np.nan
    df = spark.createDataFrame(table)
    want = table.corr("spearman")
    for r in distribution.spearman(df, ["a", "b", "c", "d"]).collect():
        assert r["r"] == pytest.approx(want.loc[r["a"], r["b"]])
    assert distribution.spearman(df, ["a", "b", "c", "d"]).count() == 6 and distribution.spearman(df, ["a"]).count() == 0


def test_density_grid_is_close_to_the_exact_kernel(spark):
    rng = np.random.default_rng(12)
    values = np.concatenate([rng.normal(0, 1, 300), rng.normal(6, 0.5, 200)])
    df = spark.createDataFrame([(1, float(v)) for v in values], "g int, x double")
    rows = sorted(distribution.kde_grid(df, "g", "x", grid=60).collect(), key=lambda r: r["point"])
    width = values.std(ddof=1) * len(values) ** -0.2
    at = np.array([r["at"] for r in rows])
    exact = np.exp(-0.5 * ((at[:, None] - values[None]) / width) ** 2).sum(1) / (len(values) * width * np.sqrt(2 * np.pi))
    assert np.abs(np.array([r["density"] for r in rows]) - exact).max() < 0.01 * exact.max()


def test_a_key_is_no_class_label(spark):
    with pytest.raises(ValueError, match="classes"):
        resample.over_sample(spark.range(1500).withColumn("y", F.col("id")), "y", "id")
