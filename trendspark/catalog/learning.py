"""Embedding, reduction, model, search and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import LABELLED_SQL, labelled, query, rounded, table
from trendspark.functions.hashing import hash_fraction_bucket
from trendspark.ml import embed, estimators, metrics, runs, search
from trendspark.ml.adaboost import adaboost as fit_adaboost
from trendspark.ml.knn import knn_classify as classify
from trendspark.ml.naive_bayes import GaussianNB
from trendspark.ml.reduce import CentredPCA
from trendspark.ml.select import rfecv as select_features
from trendspark.ml.vectors import expand, from_array
from trendspark.operators.resample import class_weights
from trendspark.plans.features import build_features as build
from trendspark.plans.features import engineer as engineer_plan
from trendspark.plans.training import ModelTrainer
from trendspark.session import c, durable, scratch_path

# --- metrics --------------------------------------------------------------------------

_PRED_SQL = "p AS (SELECT quality AS label, toxic AS pred FROM labels)"
_CELLS_SQL = f"""{_PRED_SQL}, m AS (SELECT count(*) FILTER (label = 0 AND pred = 0) AS tn, count(*) FILTER (label = 0 AND pred = 1) AS fp,
  count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 1 AND pred = 1) AS tp FROM p)"""


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(c("quality").alias("label"), c("toxic").alias("prediction"))


@query(f"WITH {_CELLS_SQL} SELECT tn, fp, fn, tp FROM m")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_predictions(spark, sf_dir))


def _div(num: str, den: str, empty: str = "0.0::double") -> str:
    return f"CASE WHEN {den} > 0 THEN ({num}) / ({den})::double ELSE {empty} END"


def _f1(hit: str, fp: str, fn: str) -> str:
    return _div(f"2 * {hit}", f"(2 * {hit} + {fp} + {fn})")


@query(
    f"""WITH {_CELLS_SQL}
SELECT round({_div('tn + tp', '(tn + fp + fn + tp)')}, 4) AS accuracy, round((({_f1('tp', 'fp', 'fn')}) + ({_f1('tn', 'fn', 'fp')})) / 2, 4) AS f1,
  round({_div('tp', '(tp + fp)')}, 4) AS precision, round({_div('tp', '(tp + fn)')}, 4) AS recall,
  round({_div('fp', '(fp + tp)', 'NULL')}, 4) AS wasted_rate, round({_div('fn', '(fn + tp)', 'NULL')}, 4) AS missed_rate FROM m"""
)
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.binary_metrics(_predictions(spark, sf_dir))
    return rounded(out, "accuracy", "f1", "precision", "recall", "wasted_rate", "missed_rate")


@query(
    f"""WITH p AS (SELECT label % 4 AS label, cast(vec_id % 5 AS int) AS pred FROM embeddings),
k AS (SELECT DISTINCT label AS k FROM p UNION SELECT DISTINCT pred FROM p),
s AS (SELECT k, count(*) FILTER (label = k AND pred = k) AS hit, count(*) FILTER (pred = k) AS guessed, count(*) FILTER (label = k) AS support FROM k, p GROUP BY 1),
f AS (SELECT k, {_div('hit', 'guessed')} AS precision, {_div('hit', 'support')} AS recall, {_div('2 * hit', '(guessed + support)')} AS f1, support, hit FROM s)
SELECT k::varchar AS class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM f
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support)::double, 4), round(sum(hit) / sum(support)::double, 4), round(sum(hit) / sum(support)::double, 4), sum(support)::bigint FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), sum(support)::bigint FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4), sum(support)::bigint FROM f"""
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several classes, one of them never true."""
    rows = table(spark, sf_dir, "embeddings").select((c("label") % 4).alias("label"), (c("vec_id") % 5).cast("int").alias("prediction"))
    return rounded(metrics.classification_report(rows), "precision", "recall", "f1")


# --- models with an exact twin ----------------------------------------------------------

_DIMS = 64
_NB_SPLIT = "('0x' || substr(md5(vec_id::varchar || '42'), 1, 8))::bigint % 100"


def _nb_sql(smoothing: float = 0.001) -> str:
    cols = ", ".join(f"embedding[{i + 1}]::double AS f{i}" for i in range(_DIMS))
    stats = ", ".join(f"avg(f{i}) AS m{i}, var_pop(f{i}) AS v{i}" for i in range(_DIMS))
    widest = "greatest(" + ", ".join(f"var_pop(f{i})" for i in range(_DIMS)) + ")"
    terms = " + ".join(f"ln(2 * pi() * (v{i} + eps)) + (f{i} - m{i}) * (f{i} - m{i}) / (v{i} + eps)" for i in range(_DIMS))
    return f"""WITH x AS (SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE 0 END AS label, {_NB_SPLIT} AS part, {cols} FROM embeddings),
t AS (SELECT * FROM x WHERE part < 60), e AS (SELECT {smoothing!r}::double * {widest} AS eps FROM t),
s AS (SELECT label AS k, count(*) / (SELECT count(*) FROM t)::double AS prior, {stats} FROM t GROUP BY 1),
j AS (SELECT vec_id, x.label, k, ln(prior) - 0.5 * ({terms}) AS joint FROM x, s, e WHERE part >= 60),
w AS (SELECT vec_id, label, max(joint) FILTER (k = 0) AS j0, max(joint) FILTER (k = 1) AS j1 FROM j GROUP BY 1, 2)
SELECT vec_id, label, CASE WHEN j1 > j0 THEN 1.0 ELSE 0.0 END::double AS prediction, round(1 / (1 + exp(j0 - j1)), 4) AS probability FROM w"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label 0/1, embedding, part): hash percentile of the key."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(c("label") < 5, 1).otherwise(0).alias("label"),
        c("embedding").cast("array<double>").alias("embedding"),
        hash_fraction_bucket("vec_id", 42, 100).alias("part"),
    )


@query(_nb_sql())
def gaussian_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = expand(_vectors(spark, sf_dir), "embedding", _DIMS, "f")
    names = [f"f{i}" for i in range(_DIMS)]
    model = GaussianNB.fit(rows.filter("part < 60"), names, "label", 1e-3)
    scored = model.transform(rows.filter("part >= 60"))
    return rounded(scored.select("vec_id", "label", "prediction", "probability"), "probability")


_NB_FOLD = "('0x' || substr(md5(vec_id::varchar || '42'), 1, 8))::bigint % 5"
_NB_GRID = ", ".join(f"({i}, {one!r}::double)" for i, one in enumerate(search.GRIDS["gaussian_nb"]["var_smoothing"]))


@query(
    f"""WITH x AS (SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE 0 END AS y, {_NB_FOLD} AS fold, unnest(range(1, {_DIMS + 1})) AS i, unnest(embedding)::double AS v FROM embeddings),
g(setting, smoothing) AS (VALUES {_NB_GRID}), k AS (SELECT unnest(range(5)) AS k),
m AS (SELECT k, y, i, count(*) AS n, avg(v) AS mean, var_pop(v) AS var FROM x JOIN k ON fold <> k GROUP BY ALL),
w AS (SELECT k, max(var) AS widest FROM (SELECT k, i, var_pop(v) AS var FROM x JOIN k ON fold <> k GROUP BY ALL) GROUP BY k),
p AS (SELECT k, y, any_value(n) / sum(any_value(n)) OVER (PARTITION BY k)::double AS prior FROM m GROUP BY k, y),
j AS (SELECT setting, x.fold, vec_id, x.y AS label, m.y AS guess, any_value(ln(prior)) - 0.5 * sum(ln(2 * pi() * (var + smoothing * widest)) + (v - mean) * (v - mean) / (var + smoothing * widest)) AS joint
  FROM x JOIN m ON x.fold = m.k AND x.i = m.i JOIN w ON w.k = m.k JOIN p ON p.k = m.k AND p.y = m.y, g GROUP BY ALL),
b AS (SELECT setting, fold, label, arg_max(guess, joint) AS guess FROM j GROUP BY setting, fold, vec_id, label),
c AS (SELECT setting, fold, cls, count(*) FILTER (label = cls AND guess = cls) AS hit, count(*) FILTER ((label = cls) <> (guess = cls)) AS miss FROM b, (VALUES (0), (1)) t(cls) GROUP BY ALL),
f AS (SELECT setting, fold, avg(2.0 * hit / (2 * hit + miss)) AS f1 FROM c WHERE hit + miss > 0 GROUP BY ALL)
SELECT setting::int AS setting, smoothing AS var_smoothing, round(avg(f1), 6) AS f1 FROM f JOIN g USING (setting) GROUP BY 1, 2"""
)
def gaussian_nb_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro F1 of the whole smoothing grid over five folds."""
    rows = search.with_folds(expand(_vectors(spark, sf_dir), "embedding", _DIMS, "f"), "vec_id", 5)
    found = search.gaussian_nb_search(search.GRIDS["gaussian_nb"]["var_smoothing"], rows, [f"f{i}" for i in range(_DIMS)], 5)
    table_ = [(i, s["var_smoothing"], float(f)) for i, (s, f) in enumerate(found)]
    return spark.createDataFrame(table_, "setting int, var_smoothing double, f1 double").withColumn("f1", F.round("f1", 6))


def _knn_sql(weights: str) -> str:
    vote = "count(*)::double" if weights == "uniform" else "sum(1 / d)"
    return f"""WITH x AS (SELECT vec_id, label, embedding::double[] AS e, {_NB_SPLIT} AS part FROM embeddings),
d AS (SELECT q.vec_id, t.label AS k, list_distance(q.e, t.e) AS d, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, t.e), t.vec_id) AS rk
  FROM x q, x t WHERE q.part >= 60 AND t.part < 60),
v AS (SELECT vec_id, k, {vote} AS v FROM d WHERE rk <= 7 GROUP BY 1, 2),
r AS (SELECT vec_id, k, v, sum(v) OVER (PARTITION BY vec_id) AS total, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, k) AS rn FROM v)
SELECT vec_id, k::double AS prediction, round(v / total, 4) AS share FROM r WHERE rn = 1"""


def _knn(spark: SparkSession, sf_dir: str, weights: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("part", hash_fraction_bucket("vec_id", 42, 100))
    out = classify(rows.filter("part < 60"), rows.filter("part >= 60"), "embedding", "label", "vec_id", 7, weights)
    return rounded(out, "share")


@query(_knn_sql("uniform"))
def knn_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir, "uniform")


@query(_knn_sql("distance"))
def knn_classify_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir, "distance")


@query("SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1")
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest metric, earliest wins a tie; suppliers stand in for runs."""
    table_ = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return runs.best_run(table_, "s_acctbal", "s_suppkey")


# --- features ---------------------------------------------------------------------------

_CLEANED_SQL = f"""{LABELLED_SQL},
clean AS (SELECT doc_id, n_chars * 3 % 900 AS likes, n_chars % 50 AS comment_count, n_chars + 1000 AS view_count, source, lang, text,
  lang || CASE WHEN doc_id % 4 < 3 THEN '-' || upper(substr(source, 1, 1)) ELSE '' END AS code,
  TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * cast(doc_id % 5000 AS int) AS published, cast(quality AS int) AS quality FROM labelled)"""


def cleaned_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of a cleaned video table."""
    doc, n = c("doc_id"), c("n_chars")
    region = F.when(doc % 4 < 3, F.concat(F.lit("-"), F.upper(F.substring("source", 1, 1)))).otherwise("")
    return labelled(spark, sf_dir).select(
        doc.cast("string").alias("video_id"),
        F.concat_ws(" ", F.lit("About"), c("source"), c("lang")).alias("title"),
        c("text").alias("description"),
        F.array(F.lit("x"), c("lang")).alias("tags"),
        (n * 3 % 900).alias("likes"),
        (n % 50).alias("comment_count"),
        (n + 1000).alias("view_count"),
        (doc % 3).alias("card_count"),
        (doc % 4).alias("chapter_count"),
        F.timestamp_add("HOUR", (doc % 5000).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("publishedAt"),
        F.concat(F.lit("PT"), (n % 90).cast("string"), F.lit("M")).alias("duration"),
        F.concat(c("lang"), region).alias("defaultLanguage"),
        (doc % 12).cast("int").alias("categoryId"),
        c("quality").alias("is_trending"),
    )


@query(
    f"""WITH {_CLEANED_SQL}, parts AS (SELECT *, string_split(code, '-')[1] AS base, coalesce(string_split(code, '-')[2], 'NO') AS region FROM clean),
b AS (SELECT base, count(*) / (SELECT count(*) FROM parts)::double AS s FROM parts GROUP BY 1), r AS (SELECT region, count(*) / (SELECT count(*) FROM parts)::double AS s FROM parts GROUP BY 1)
SELECT doc_id::varchar AS video_id, round(likes / view_count::double, 4) AS like_to_view_ratio, round(comment_count / view_count::double, 4) AS comment_to_view_ratio, 2 AS tag_count,
  cast(length('About ' || source || ' ' || lang) AS int) AS title_length, cast(length(text) AS int) AS description_length, 'x ' || lang AS tags_joined,
  CASE WHEN doc_id % 3 > 0 THEN 1 ELSE 0 END AS has_cards, CASE WHEN doc_id % 4 > 0 THEN 1 ELSE 0 END AS has_chapter,
  cast(hour(published) AS int) AS publish_hour, cast(isodow(published) - 1 AS int) AS publish_dayofweek,
  CASE WHEN b.s < 0.002 THEN 'other' ELSE p.base END AS lang_base, CASE WHEN r.s < 0.005 THEN 'other' ELSE p.region END AS lang_region,
  384 AS title_width, 384 AS description_width, 384 AS tags_joined_width
FROM parts p JOIN b ON p.base = b.base JOIN r ON p.region = r.region"""
)
def build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios, text, time and language features of a cleaned table, and its three texts embedded."""
    out = build(cleaned_videos(spark, sf_dir))
    widths = [F.size(f"{n}_emb").alias(f"{n}_width") for n in ("title", "description", "tags_joined")]
    out = out.select(*widths, 
        "video_id", "like_to_view_ratio", "comment_to_view_ratio", "tag_count", "title_length", "description_length", "tags_joined",
        "has_cards", "has_chapter", "publish_hour", "publish_dayofweek", "lang_base", "lang_region",
    )
    return rounded(out, "like_to_view_ratio", "comment_to_view_ratio")


@query()
def engineer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records to encoded, reduced, selected and scaled splits; rows per split."""
    rows = cleaned_videos(spark, sf_dir).withColumn("is_trending", F.coalesce(c("is_trending"), (c("likes") > 400).cast("int")))
    done = engineer_plan(rows, embed=("title",), components=5, rare_rows=20, step=6, folds=3)
    parts = [p.select(F.lit(n).alias("part"), "is_trending") for n, p in (("train", done.train), ("val", done.val), ("test", done.test))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("part", "is_trending").agg(F.count(F.lit(1)).alias("n"))


@query()
def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed, rarity-weighted unit vectors of whole texts."""
    docs = embed.embed_text(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])
    norm = F.sqrt(F.aggregate("text_emb", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return docs.select("doc_id", F.size("text_emb").alias("size"), F.round(norm, 3).alias("norm"))


@query()
def principal_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten components fitted on the training part, projected for the rest."""
    rows = _vectors(spark, sf_dir)
    return CentredPCA.fit(rows.filter("part < 60"), "embedding", 10).apply(rows.filter("part >= 60"), "embedding")


@query()
def explained_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CentredPCA.fit(_vectors(spark, sf_dir), "embedding", 10).explained_variance(spark)


@query()
def rfecv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean F1 by number of features kept."""
    rows = search.with_folds(from_array(_vectors(spark, sf_dir), "embedding"), "vec_id", 3)
    kept, scores = select_features(rows, 64, step=16, folds=3)
    found = [(n, float(s), n == len(kept)) for n, s in sorted(scores.items())]
    return spark.createDataFrame(found, "n_features int, f1 double, chosen boolean")


# --- Spark ML models ----------------------------------------------------------------------


def _ready(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = durable(class_weights(from_array(_vectors(spark, sf_dir), "embedding"), "label"), "vectors")
    return rows.filter("part < 60"), rows.filter("part >= 60")


def _scored(model, test: DataFrame) -> DataFrame:
    return rounded(runs.score_batch(model, test).select("vec_id", "label", "prediction", "will_trend", "probability"), "probability")


@query()
def adaboost(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _ready(spark, sf_dir)
    return _scored(fit_adaboost(train, rounds=50), test)


@query()
def linear_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No probability from this model."""
    train, test = _ready(spark, sf_dir)
    return _scored(estimators.linear_svc(train.count(), 1.0, "weight", 100).fit(train), test)


@query()
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _ready(spark, sf_dir)
    return _scored(estimators.random_forest(100, 5, weight="weight").fit(train), test)


@query()
def logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _ready(spark, sf_dir)
    return _scored(estimators.logistic(train.count(), 1.0, "l1", "weight").fit(train), test)


@query()
def decision_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _ready(spark, sf_dir)
    return _scored(estimators.decision_tree(5).fit(train), test)


@query()
def gradient_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _ready(spark, sf_dir)
    return _scored(estimators.gbt(50, 3, 0.2, 0.8, "weight").fit(train), test)


@query()
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated macro F1 of the whole standard grid of logistic regression, five folds."""
    train, _ = _ready(spark, sf_dir)
    rows = train.count()
    grid = search.expand_grid(search.GRIDS["logistic"])
    mix = {"l1": 1.0, "l2": 0.0}
    settings = [{"regParam": estimators.reg_param(s["C"], rows), "elasticNetParam": mix[s["penalty"]]} for s in grid]
    found = search.grid_search(estimators.logistic(rows), settings, search.with_folds(train, "vec_id", 5), 5)
    out = [(i, float(s["C"]), s["penalty"], float(f)) for i, (s, f) in enumerate(zip(grid, found.avgMetrics, strict=True))]
    return spark.createDataFrame(out, "setting int, c double, penalty string, f1 double")


@query()
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawn settings scored on one validation split."""
    train, _ = _ready(spark, sf_dir)
    space = {"maxDepth": ("int", 2, 5), "minInfoGain": ("log", 1e-4, 1e-1)}
    found = search.random_search(estimators.decision_tree(), space, 10, train, key="vec_id")
    return spark.createDataFrame([(i, float(f)) for i, f in enumerate(found.validationMetrics)], "setting int, f1 double")


@query()
def run_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs recorded; the table of runs."""
    train, test = _ready(spark, sf_dir)
    path = scratch_path(spark, "runs")
    runs.run_experiment(spark, "tree", estimators.decision_tree(4), train, test, path, {"max_depth": 4}, {"stage": "baseline"})
    runs.run_experiment(spark, "svc", estimators.linear_svc(train.count(), max_iter=20), train, test, path, {"C": 1.0}, {"stage": "baseline"})
    return runs.read_runs(spark, path).select("name", *runs.RUN_METRICS)


@query(f"SELECT vec_id, prediction, 'Gaussian_NB_v2' AS version FROM ({_nb_sql(1e-9)})")
def save_model_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions count up; the saved model scores like the fitted one."""
    train, test = _ready(spark, sf_dir)
    names = [f"f{i}" for i in range(_DIMS)]
    model = GaussianNB.fit(expand(train.drop("features"), "embedding", _DIMS, "f"), names, "label")
    folder = scratch_path(spark, "models")
    paths = [runs.save_model_version(spark, model, folder, "Gaussian NB") for _ in range(2)]
    again = GaussianNB.load(spark, paths[1])
    scored = again.transform(expand(test.drop("features"), "embedding", _DIMS, "f"))
    return scored.select("vec_id", "prediction", F.lit(paths[1].rsplit("/", 1)[1]).alias("version"))


@query()
def train_and_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three model families searched over their whole grids with five folds, the best one reported on the test part."""
    rows = durable(expand(_vectors(spark, sf_dir), "embedding", _DIMS, "f"), "rows")
    parts = [rows.filter("part < 60"), rows.filter("part >= 60 and part < 80"), rows.filter("part >= 80")]
    trainer = ModelTrainer(spark, *parts, "vec_id", "label", [f"f{i}" for i in range(_DIMS)])
    trainer.train_gaussian_nb("smote")
    trainer.train_logistic_regression("balanced")
    trainer.train_svc("balanced")
    return trainer.test_report()
