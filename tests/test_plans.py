"""Sources, cleaning, acquisition, features, models and streaming end to end on small data."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.ml import estimators, metrics, runs, search
from trendspark.ml.adaboost import AdaBoostModel, adaboost
from trendspark.ml.embed import embed_text
from trendspark.ml.knn import knn_classify
from trendspark.ml.naive_bayes import GaussianNB
from trendspark.ml.reduce import CentredPCA
from trendspark.ml.select import rfecv
from trendspark.ml.vectors import assemble, from_array
from trendspark.operators.resample import class_weights
from trendspark.plans import acquire, cleaning, features, pages
from trendspark.plans.training import ModelTrainer
from trendspark.schema import RAW_COLUMNS, raw_schema
from trendspark.session import durable, scratch_path, shared_root
from trendspark.sources import flatten, readers, writers
from trendspark.streaming.ingest import incremental_ingest

RAW = "video_id string, view_count int, likes int, comment_count int, comments_disabled string, tags string, defaultLanguage string, duration string, title string, description string"


@pytest.fixture
def raw(spark):
    data = [
        ("k-01", 90210, 4411, 37, "False", "[surf, 'sun set']", "pt-BR", "PT2M8S", "Waves 🌊 at dawn", "Shot by hand"),
        ("k-02", 77, 78, 0, "False", "one,two , three", "de-AT", "PT45S", "More likes than views", None),
        ("k-03", 640, 31, 4, "True", None, "??", "P2DT1M", "Comments though disabled", "x"),
        ("k-01", 90210, 4411, 37, "False", "[surf, 'sun set']", "pt-BR", "PT2M8S", "Waves 🌊 at dawn", "Shot by hand"),
    ]
    return spark.createDataFrame([(*row, i) for i, row in enumerate(data)], RAW + ", _row int")


# --- session and sources ----------------------------------------------------------------------


def test_shared_root_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_root(spark) == configured.rstrip("/")


def test_durable_keeps_schema_and_gives_a_size(spark):
    df = durable(spark.createDataFrame([(1, [1.0], None)], "`a.b` int, v array<double>, s string"))
    assert df.columns == ["a.b", "v", "s"]
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000


def test_raw_schema(spark):
    assert raw_schema().names == RAW_COLUMNS and len(RAW_COLUMNS) == 37


def test_csv_round_trip(spark):
    df = spark.createDataFrame([("a", 'say "hi"\nthere, you', ["x", "y"]), ("b", "  padded ", None)], "k string, t string, tags array<string>")
    path = scratch_path(spark, "csv")
    writers.write_table(df, path, "csv")
    schema = T.StructType.fromDDL("k string, t string, tags string")
    got = {r["k"]: (r["t"], r["tags"]) for r in readers.read_videos_csv(spark, path, schema).collect()}
    assert got == {"a": ('say "hi"\nthere, you', '["x","y"]'), "b": ("  padded ", None)}
    empty = readers.read_csv_keep_empty(spark, path, schema, ["t", "tags"]).filter("k = 'b'").first()
    assert empty["tags"] == ""


def test_progress_last_line_wins(spark):
    path = scratch_path(spark, "progress")
    df = spark.createDataFrame([("v1", 5), ("v2", 2)], "video_id string, chapters int")
    writers.append_progress(df.coalesce(1), path)
    spark.createDataFrame([('{"video_id": "v1", "chapters": 9}',), ('{"video_id": "v3", "chap',)], "value string").coalesce(1).write.mode("append").text(path)
    got = readers.read_progress(spark, path, "video_id", df.schema, None)
    assert {r["video_id"] for r in got.collect()} == {"v1", "v2"}
    latest = readers.read_progress(spark, path, "video_id", df.schema, "chapters")
    assert {tuple(r) for r in latest.collect()} == {("v1", 9), ("v2", 2)}


def test_language_codes(spark, tmp_path):
    target = tmp_path / "hl.json"
    target.write_text(json.dumps({"items": [{"snippet": {"hl": h}} for h in ("en-US", "en-GB", "fr", "es-419")]}))
    got = {r["code"] for r in readers.load_language_codes(spark, str(target), ["und"]).collect()}
    assert got == {"en", "fr", "es", "und"}
    target.write_text(json.dumps({"items": []}))
    assert readers.load_language_codes(spark, str(target), []).count() == 0


def test_flatten_items(spark, tmp_path):
    item = {
        "id": "q-77",
        "snippet": {"title": "Knots", "tags": ["rope", "sea"], "thumbnails": {"default": {"url": "https://i.test/7.jpg"}, "maxres": {"url": "big"}}},
        "statistics": {"viewCount": "12"},
        "contentDetails": {"regionRestriction": {"blocked": ["SE", "NO"]}},
    }
    target = tmp_path / "items.json"
    target.write_text(json.dumps([item]))
    out = acquire.items_table(readers.read_items_json(spark, str(target)))
    assert set(out.columns) == {"video_id", "title", "tags", "thumbnail_link", "view_count", "contentDetails.regionRestriction.blocked"}
    assert out.first()["thumbnail_link"] == "https://i.test/7.jpg"
    assert flatten.flat_name(("a", "b", "c")) == "a.b.c"


def test_cached_computes_once(spark):
    path = scratch_path(spark, "backup")
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([(1, "a")], "id int, x string")

    for _ in range(2):
        assert readers.cached(spark, path, compute).first()["x"] == "a"
    assert len(calls) == 1


# --- cleaning ---------------------------------------------------------------------------------


def test_steps(spark, raw):
    once = cleaning.remove_duplicates(raw)
    assert once.count() == 3
    assert {r["video_id"] for r in cleaning.filter_invalid_rows(raw).collect()} == {"k-01"}
    described = cleaning.fix_description(raw).filter("video_id = 'k-02'").first()
    assert described["description"] == ""
    filled = cleaning.fix_comment_count(spark.createDataFrame([(None, "True"), (None, "False"), (5, "False")], "comment_count int, comments_disabled string"))
    assert [r["comment_count"] for r in filled.collect()] == [0, None, 5]


def test_default_pipeline(spark, raw):
    codes = spark.createDataFrame([("pt",), ("de",)], "code string")
    pipeline = cleaning.build_default_pipeline(codes)
    out = pipeline.fit_transform(raw)
    row = out.first()
    assert out.count() == 1 and row["video_id"] == "k-01" and row["tags"] == ["surf", "'sun set'"]
    assert row["view_count"] == pytest.approx(np.log1p(90210))
    assert pipeline.log.initial_shape == (4, 11) and pipeline.log.final_shape[0] == 1
    log = [(r["step"], r["records_affected"]) for r in pipeline.log.to_df(spark).orderBy("position").collect()]
    assert log[:2] == [("Accuracy", 1), ("Consistency", 2)] and len(log) == 11
    lazy = cleaning.build_default_pipeline(codes).transform(raw)
    assert lazy.drop("_row").collect() == out.drop("_row").collect()


def test_language_log_counts_replacements(spark):
    df = spark.createDataFrame([("en-US",), ("zz",), ("unknown",), (None,)], "defaultLanguage string")
    pipeline = cleaning.CleaningPipeline().add_step("L", cleaning.clean_default_language, codes=spark.createDataFrame([("en",)], "code string"))
    out = pipeline.fit_transform(df)
    assert sorted(str(r[0]) for r in out.collect()) == ["None", "en-US", "unknown", "unknown"]
    assert pipeline.log.entries[0].affected == 2


def test_pipeline_is_open(spark):
    given = []

    def keep_below(df, log=None, top=None):
        given.append(top)
        if log is not None:
            log.record("Own step", "too large", log.count(df, F.col("size") >= top), "drop", "none")
        return df.filter(F.col("size") < top)

    pipeline = cleaning.CleaningPipeline()
    assert pipeline.add_step("Below", keep_below, top=7) is pipeline
    out = pipeline.fit_transform(spark.createDataFrame([(v, "x") for v in (9, 3, 7, 6)], "size int, name string"))
    assert sorted(r["size"] for r in out.collect()) == [3, 6] and given == [7]
    assert pipeline.log.initial_shape == (4, 2) and pipeline.log.final_shape == (2, 2)
    assert pipeline.log.to_df(spark).first()["records_affected"] == 2


# --- pages and streaming ------------------------------------------------------------------------


def test_page_features_drop_failed_pages(spark):
    df = spark.createDataFrame([("v1", "<html></html>"), ("v2", None)], "video_id string, html string")
    out = pages.page_features(df).collect()
    assert len(out) == 1
    assert out[0].asDict() == {
        "video_id": "v1",
        "chapter_count": 0,
        "chapters": [],
        "playability_status": "UNKNOWN",
        "supports_miniplayer": False,
        "card_count": 0,
        "cards": [],
        "is_verified": False,
        "badge_labels": [],
        "comments_disabled": False,
        "has_paid_promotion": False,
    }


def test_incremental_ingest_resumes(spark):
    schema = T.StructType.fromDDL("video_id string, n int")
    home = scratch_path(spark, "ingest")

    def add(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").json(f"{home}/in")

    def run():
        return {tuple(r) for r in incremental_ingest(spark, f"{home}/in", f"{home}/out", f"{home}/state", schema, "video_id", ["n"]).collect()}

    add(("a", 2), ("a", 1), ("b", 5))
    assert run() == {("a", 1), ("b", 5)}
    assert run() == {("a", 1), ("b", 5)}
    add(("b", 0), ("c", 7), (None, 1))
    assert run() == {("a", 1), ("b", 5), ("c", 7)}


# --- features and models ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(42)
    data = []
    for i in range(400):
        y = int(i % 4 == 0)
        data.append((f"k{i}", y, [float(v) for v in rng.normal(y * 1.5, 1.0, 5)]))
    df = spark.createDataFrame(data, "key string, label int, vec array<double>")
    return durable(search.with_folds(class_weights(from_array(df, "vec"), "label"), "key", 3))


def test_build_features(spark):
    data = [
        ("a", 7, 3, 55, "[red, 'deep blue', ]", "Two 🎈 and one 🚀!", "Long TEXT", 0, 12, "2023-12-31T23:05:00Z", "PT3H7S", "nb-NO"),
        ("b", 0, 0, 0, '["x", "y", "z"]', "plain", "", 4, 0, "2024-02-29T00:00:00Z", "P1DT1S", None),
    ]
    names = "video_id string, likes int, comment_count int, view_count int, tags string, title string, description string, card_count int, chapter_count int, publishedAt string, duration string, defaultLanguage string"
    out = features.build_features(spark.createDataFrame(data, names), encode=lambda texts: [[0.1, 0.2]] * len(texts)).orderBy("video_id").collect()
    assert [r["has_cards"] for r in out] == [0, 1] and [r["has_chapter"] for r in out] == [1, 0]
    assert [r["tag_count"] for r in out] == [3, 3] and [r["tags_joined"] for r in out] == ["", "x y z"]
    assert [r["publish_hour"] for r in out] == [23, 0] and [r["publish_dayofweek"] for r in out] == [6, 3]
    assert [r["duration_seconds"] for r in out] == [10807, 86401] and [r["title_emoji_count"] for r in out] == [2, 0]
    assert out[1]["tags_joined_emb"] == pytest.approx([0.1, 0.2])


def test_embed_text(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, ""), (3, None), (4, "a x")], "i int, t string")
    out = {r["i"]: np.array(r["t_emb"]) for r in embed_text(df, ["t"], size=32).collect()}
    assert all(len(v) == 32 for v in out.values())
    assert np.linalg.norm(out[1]) == pytest.approx(1.0, abs=1e-5)
    assert (out[2] == out[3]).all()
    given = embed_text(df, ["t"], lambda batch: [[float(len(t or ""))] for t in batch]).orderBy("i").collect()
    assert [r["t_emb"] for r in given] == [[5.0], [7.0], [7.0], [3.0]]  # a missing text is the word "missing"



def test_pca_is_centred_with_fixed_sign(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) @ np.diag([5, 2, 1, 0.1]) + 10
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id int, vec array<double>")
    model = CentredPCA.fit(df, "vec", 2)
    got = model.apply(df, "vec").orderBy("id").toPandas()[["pca_0", "pca_1"]].to_numpy()
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    for k in range(2):
        axis = vt[k] * np.sign(vt[k][np.abs(vt[k]).argmax()])
        assert got[:, k] == pytest.approx((x - x.mean(0)) @ axis, abs=1e-6)
    ratio = [r["ratio"] for r in model.explained_variance(spark).orderBy("component").collect()]
    assert ratio == pytest.approx((s**2 / (s**2).sum())[:2].tolist())


def test_gaussian_nb(spark, separable):
    names = [f"f{i}" for i in range(5)]
    rows = separable.select("key", "label", *[F.col("vec")[i].alias(n) for i, n in enumerate(names)])
    model = GaussianNB.fit(rows, names, "label", 1e-9)
    x = rows.toPandas()
    eps = 1e-9 * x[names].var(ddof=0).max()
    joint = []
    for k in (0, 1):
        g = x[x.label == k][names]
        var = g.var(ddof=0) + eps
        joint.append(np.log(len(g) / len(x)) - 0.5 * (np.log(2 * np.pi * var).sum() + ((x[names] - g.mean()) ** 2 / var).sum(axis=1)))
    got = model.transform(rows).toPandas().set_index("key")["prediction"]
    assert (got[x["key"]].to_numpy() == (joint[1] > joint[0]).astype(float).to_numpy()).all()


def test_knn_vote(spark):
    train = spark.createDataFrame([("a", 0, [0.0]), ("b", 0, [0.2]), ("c", 1, [1.0])], "key string, label int, vec array<double>")
    q = spark.createDataFrame([("q", [1.0]), ("r", [0.9])], "key string, vec array<double>")
    uniform = {r["key"]: r["prediction"] for r in knn_classify(train, q, "vec", "label", "key", 3).collect()}
    near = {r["key"]: (r["prediction"], r["share"]) for r in knn_classify(train, q, "vec", "label", "key", 3, "distance").collect()}
    assert uniform == {"q": 0.0, "r": 0.0}
    assert near["q"] == (1.0, 1.0) and near["r"][0] == 1.0


def test_adaboost(spark, separable):
    model = adaboost(separable, rounds=12, rewrite_every=5)
    scored = model.transform(separable)
    assert metrics.binary_metrics(scored).first()["accuracy"] > 0.85
    path = scratch_path(spark, "ada")
    model.save(spark, path)
    assert AdaBoostModel.load(spark, path) == model


def test_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (1, 0)], "label int, prediction int")
    row = metrics.binary_metrics(df).first()
    assert (row["precision"], row["recall"], row["wasted_rate"], row["missed_rate"]) == (0.0, 0.0, None, 1.0)
    assert row["f1"] == pytest.approx(1 / 3)
    single = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    assert metrics.binary_metrics(single).first()["f1"] == 1.0
    report = {r["class"]: r["f1"] for r in metrics.classification_report(df).collect()}
    assert report["0"] == pytest.approx(2 / 3) and report["1"] == 0.0 and report["accuracy"] == 0.5


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, s double")
    assert metrics.roc_auc(df, "s").first()[0] == pytest.approx(0.875)


def test_estimators_beat_chance(spark, separable):
    n = separable.count()
    models = [
        estimators.linear_svc(n, 1.0, "weight", 20),
        estimators.logistic(n, 1.0, "l2", "weight", 50),
        estimators.decision_tree(4, "weight"),
        estimators.random_forest(10, 4, weight="weight"),
        estimators.gbt(5, 3, weight="weight"),
    ]
    for est in models:
        scored = runs.score_batch(est.fit(separable), separable)
        assert metrics.MacroF1Evaluator().evaluate(scored.withColumn("prediction", F.col("prediction").cast("double"))) > 0.7
        assert (scored.filter("probability is null").count() == n) is (type(est).__name__ == "LinearSVC")


def test_stratified_folds_are_even(spark):
    df = spark.range(103).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    sizes = search.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_draw_repeats(spark):
    space = {"a": ("int", 1, 5), "b": ("log", 0.01, 1.0), "c": ["x", "y"]}
    assert search.draw(space, 4, 1) == search.draw(space, 4, 1)
    assert search.best_setting([({"k": 1}, 0.5), ({"k": 2}, 0.5)])[0] == {"k": 1}


def test_rfecv_keeps_the_signal(spark):
    rng = np.random.default_rng(9)
    data = [(f"k{i}", int(i % 2), float(i % 2 + rng.normal(0, 0.2)), *[float(v) for v in rng.normal(size=3)]) for i in range(300)]
    df = assemble(spark.createDataFrame(data, "key string, label int, s double, n1 double, n2 double, n3 double"), ["n1", "s", "n2", "n3"])
    kept, scores = rfecv(search.with_folds(df, "key", 2), 4, step=1, folds=2, max_depth=3)
    assert 1 in kept and set(scores) == {1, 2, 3, 4}


def test_runs_and_versions(spark, separable):
    path, folder = scratch_path(spark, "runs"), scratch_path(spark, "models")
    tree, _ = runs.run_experiment(spark, "tree", estimators.decision_tree(3), separable, separable, path, {"depth": 3}, {"stage": "test"})
    found = search.grid_search(estimators.decision_tree(), [{"maxDepth": 1}, {"maxDepth": 3}], separable, 3)
    _, model = runs.run_experiment(spark, "searched", found, None, separable, path)
    logged = runs.read_runs(spark, path)
    assert logged.count() == 2 and logged.filter("name = 'searched'").first()["best_cv_score"] is not None
    assert runs.best_run(logged).first()["f1"] == pytest.approx(max(r["f1"] for r in logged.collect()))
    first = runs.save_model_version(spark, model, folder, "Decision Tree")
    second = runs.save_model_version(spark, model, folder, "Decision Tree")
    assert (first[-3:], second[-3:]) == ("_v1", "_v2")
    assert tree["accuracy"] > 0.8


def test_trainer(spark, separable):
    names = [f"f{i}" for i in range(5)]
    wide = separable.select("key", "label", "fold", *[F.col("vec")[i].alias(n) for i, n in enumerate(names)])
    parts = [wide.filter("fold = 0"), wide.filter("fold = 1"), wide.filter("fold = 2")]
    trainer = ModelTrainer(spark, *[p.drop("fold") for p in parts], "key", "label", names, folds=2)
    trainer.train_gaussian_nb("smote", {"var_smoothing": [1e-9]})
    trainer.train_logistic_regression("balanced", {"C": [1.0], "penalty": ["l2"]})
    assert trainer.best_f1 == max(m["f1"] for _, m in trainer.log)
    report = trainer.test_report(scratch_path(spark, "models"))
    assert {r["class"] for r in report.collect()} >= {"0", "1", "macro avg"}


@pytest.mark.parametrize(
    ("name", "mode", "given"),
    [
        ("train_knn", None, {"grid": {"n_neighbors": [3], "weights": ["uniform", "distance"]}}),
        ("train_ada", "under", {"grid": {"n_estimators": [3], "learning_rate": [1.0]}, "trials": 1}),
        ("train_svc", "over", {"grid": {"C": [1.0]}}),
        ("train_random_forest", "balanced", {"grid": {"n_estimators": [5], "max_depth": [3], "min_samples_split": [2]}}),
        ("train_gbt", None, {"space": {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 3), "learning_rate": ("log", 0.1, 0.3), "subsample": ("uniform", 0.8, 1.0)}, "trials": 2}),
    ],
)
def test_every_trainer(spark, separable, name, mode, given):
    names = [f"f{i}" for i in range(5)]
    wide = separable.select("key", "label", "fold", *[F.col("vec")[i].alias(n) for i, n in enumerate(names)])
    parts = [wide.filter(F.col("fold") == k).drop("fold") for k in range(3)]
    trainer = ModelTrainer(spark, *parts, "key", "label", names, folds=2)
    got = getattr(trainer, name)(mode, **given)
    assert got["f1"] > 0.6 and trainer.best_model is not None
    assert trainer.test_report().count() >= 4


def test_copies_have_the_same_keys_in_every_run(spark, separable):
    wide = separable.select("key", "label", *[F.col("vec")[i].alias(f"f{i}") for i in range(5)])
    trainer = ModelTrainer(spark, wide, wide, wide, "key", "label", [f"f{i}" for i in range(5)], folds=3)
    one, two = ({(r["key"], r["fold"]) for r in trainer.sampled("over").select("key", "fold").collect()} for _ in range(2))
    assert one == two and len(one) == 600
    spread = trainer.sampled("over").groupBy("label", "fold").count().collect()
    assert {r["count"] for r in spread} == {100}


def test_random_search_does_not_depend_on_partitions(spark, separable):
    space = {"maxDepth": ("int", 2, 4)}
    found = [search.random_search(estimators.decision_tree(), space, 2, separable.repartition(n)).validationMetrics for n in (1, 5)]
    assert found[0] == pytest.approx(found[1])


def test_scoring_checks_feature_names(spark, separable):
    wide = separable.select("label", "weight", *[F.col("vec")[i].alias(f"f{i}") for i in range(5)])
    model = estimators.decision_tree(2).fit(assemble(wide, ["f0", "f1"]))
    assert runs.score_batch(model, assemble(wide, ["f0", "f1"]), ["f0", "f1"]).count() == 400
    with pytest.raises(ValueError, match="f1"):
        runs.score_batch(model, assemble(wide, ["f0", "f2"]), ["f0", "f1"])


def test_rows_follow_the_order_of_files(spark, tmp_path):
    for name, n in (("a_first.csv", 1), ("b_second.csv", 400)):
        (tmp_path / name).write_text("k,t\n" + f"same,{name}\n" * n)
    df = readers.read_videos_csv(spark, str(tmp_path), T._parse_datatype_string("k string, t string"))
    assert readers.keep_first(df, "k").first()["t"] == "a_first.csv"


def test_backup_keeps_types_and_columns(spark):
    schema = "id int, d date, x string, v array<double>"
    for rows in ([(1, None, None, None)], []):
        path = scratch_path(spark, "backup")
        df = spark.createDataFrame(rows, schema)
        assert readers.cached(spark, path, lambda df=df: df).schema == readers.cached(spark, path, lambda: None).schema == df.schema


def test_acquire_keeps_one_row_per_candidate(spark):
    base = spark.createDataFrame([("a", False)], "video_id string, is_trending boolean")
    item = "id string, statistics struct<viewCount:int>"
    details = spark.createDataFrame([("a", (5,)), ("a", (5,))], item)
    hot = spark.createDataFrame([("h", (7,))], item)
    new = spark.createDataFrame([("n", (2,)), ("n", (3,)), ("a", (9,))], item)
    scraped = spark.createDataFrame([("n", 4)], "video_id string, card_count int")
    out = [r["video_id"] for r in acquire.acquire(base, details, hot, new, scraped, "2024-05-06").collect()]
    assert sorted(out) == ["a", "h", "n"]
