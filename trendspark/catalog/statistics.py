"""Distribution, correlation and outlier queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import VIDEOS_SQL, query, rounded, table, videos
from trendspark.operators import distribution, encoding, sampling
from trendspark.ml.metrics import roc_auc as roc_auc_op
from trendspark.session import c, durable

_LOGGED_SQL = "logged AS (SELECT l_returnflag, ln(l_extendedprice + 1) AS price, ln(l_quantity + 1) AS quantity FROM lineitem)"


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", c("l_extendedprice").alias("price"), c("l_quantity").alias("quantity"))
    return distribution.log1p_columns(lines, ["price", "quantity"], keep=["l_returnflag"])


def _box_sql(name: str) -> str:
    return f"""SELECT l_returnflag, '{name}' AS "column", l.{name} AS v, b.q1, b.median, b.q3, b.n FROM logged l JOIN (
  SELECT l_returnflag, quantile_cont({name}, 0.25) AS q1, quantile_cont({name}, 0.5) AS median, quantile_cont({name}, 0.75) AS q3, count({name}) AS n
  FROM logged GROUP BY 1) b USING (l_returnflag)"""


@query(
    f"""WITH {_LOGGED_SQL}, x AS ({_box_sql('price')} UNION ALL {_box_sql('quantity')})
SELECT l_returnflag, "column", n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
  round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
  count(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM x GROUP BY l_returnflag, "column", n, x.q1, x.median, x.q3"""
)
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = distribution.box_stats(_logged(spark, sf_dir), "l_returnflag", ["price", "quantity"])
    return rounded(out, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    """WITH x AS (SELECT ln(l_extendedprice + 1) AS v FROM lineitem), r AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT least(cast(floor((v - lo) / ((hi - lo) / 50)) AS int), 49) AS bin FROM x, r), n AS (SELECT bin, count(*) AS n FROM b GROUP BY 1)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 50), 4) AS lo, round(lo + (g.bin + 1) * ((hi - lo) / 50), 4) AS hi, coalesce(n, 0) AS n
FROM (SELECT cast(range AS int) AS bin FROM range(50)) g CROSS JOIN r LEFT JOIN n ON n.bin = g.bin"""
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(distribution.histogram(_logged(spark, sf_dir), "price", 50), "lo", "hi")


@query(
    """WITH x AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS grp, ln(o_totalprice + 1) AS x FROM orders),
s AS (SELECT grp, count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi, stddev_samp(x) * pow(count(*), -0.2) AS bw, (max(x) - min(x)) / 1024 AS w FROM x GROUP BY 1),
b AS (SELECT x.grp, least(cast(floor((x - lo) / w) AS int), 1023) AS bin, count(*) AS cnt FROM x JOIN s USING (grp) GROUP BY 1, 2),
p AS (SELECT b.grp, g.point, cnt, n, bw, lo + (bin + 0.5) * w AS centre, lo - 3.0 * bw + g.point * ((hi - lo + 6.0 * bw) / 199) AS spot
  FROM b JOIN s USING (grp), (SELECT cast(range AS int) AS point FROM range(200)) g)
SELECT grp, point, round(max(spot), 4) AS "at", round(sum(exp(-0.5 * ((spot - centre) / bw) * ((spot - centre) / bw)) * cnt / (n * bw * sqrt(2 * pi()))), 4) AS density FROM p GROUP BY 1, 2"""
)
def kde_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density of log prices per class."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(c("o_orderstatus") == "F", 1).otherwise(0).alias("grp"), F.log1p("o_totalprice").alias("x")
    )
    return rounded(distribution.kde_grid(orders, "grp", "x"), "at", "density")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) + 0.0 AS r FROM lineitem" for a, b in combinations(_MEASURES, 2)))
def pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(distribution.pearson(table(spark, sf_dir, "lineitem"), _MEASURES), "r")


_VIDEO_COUNTS = ["view_count", "likes", "comment_count"]


def _spearman_sql(a: str, b: str) -> str:
    def ranked(col: str) -> str:
        return f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0"

    return f"""SELECT '{a}' AS a, '{b}' AS b, round(corr(ra, rb), 4) + 0.0 AS r FROM (
  SELECT {ranked(a)} AS ra, {ranked(b)} AS rb FROM videos WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query(f"WITH {VIDEOS_SQL} " + " UNION ALL ".join(_spearman_sql(a, b) for a, b in combinations(_VIDEO_COUNTS, 2)))
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = durable(videos(spark, sf_dir).select(*_VIDEO_COUNTS), "videos")
    return rounded(distribution.spearman(vids, _VIDEO_COUNTS), "r")


_LOG_COLS = ["view_count", "likes", "comment_count", "is_trending"]


@query(
    f"WITH {VIDEOS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(ln({a} + 1.0), ln({b} + 1.0)), 4) + 0.0 AS r FROM videos" for a, b in combinations(_LOG_COLS, 2)
    )
)
def corr_matrix_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(distribution.corr_matrix_log(videos(spark, sf_dir), _LOG_COLS), "r")


def _skew_sql(name: str) -> str:
    n = f"count({name})"
    return f"""SELECT '{name}' AS "column", round(skewness({name}), 4) AS skew, round(skewness({name}) * ({n} - 2) / sqrt({n} * ({n} - 1.0)), 4) AS population FROM videos"""


@query(f"WITH {VIDEOS_SQL} " + " UNION ALL ".join(_skew_sql(n) for n in _VIDEO_COUNTS))
def skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = videos(spark, sf_dir)
    adjusted = distribution.skew(vids, _VIDEO_COUNTS)
    plain = distribution.skew(vids, _VIDEO_COUNTS, adjusted=False).withColumnRenamed("skew", "population")
    # Three rows on each side.
    return rounded(adjusted.join(F.broadcast(plain), "column"), "skew", "population")


def _bounds_sql(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "column", method, round(lo, 4) AS lower, round(hi, 4) AS upper, (SELECT count(*) FROM {source} WHERE {name} < lo OR {name} > hi) AS outliers FROM (
  SELECT 'iqr' AS method, quantile_cont({name}, 0.25) - 1.5 * (quantile_cont({name}, 0.75) - quantile_cont({name}, 0.25)) AS lo,
    quantile_cont({name}, 0.75) + 1.5 * (quantile_cont({name}, 0.75) - quantile_cont({name}, 0.25)) AS hi FROM {source}
  UNION ALL SELECT 'zscore', avg({name}) - 2 * stddev_pop({name}), avg({name}) + 2 * stddev_pop({name}) FROM {source})"""


@query(f"WITH {VIDEOS_SQL} " + " UNION ALL ".join(_bounds_sql(n, "videos") for n in _VIDEO_COUNTS))
def outlier_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = durable(videos(spark, sf_dir).select(*_VIDEO_COUNTS), "videos")
    return rounded(distribution.outlier_bounds(vids, _VIDEO_COUNTS, "both", z=2.0), "lower", "upper")


@query(
    f"""WITH {VIDEOS_SQL}, b AS ({' UNION ALL '.join(_bounds_sql(n, 'videos') for n in _VIDEO_COUNTS)})
SELECT "column", outliers FROM b WHERE method = 'iqr' AND outliers > 0"""
)
def columns_with_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = durable(videos(spark, sf_dir).select(*_VIDEO_COUNTS), "videos")
    return distribution.columns_with_outliers(vids, _VIDEO_COUNTS)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::double AS avg_rank FROM lineitem")
def average_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the average rank of its quantity: few values, each shared by many rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return distribution.average_rank(lines, "l_quantity")


@query(
    """WITH p AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, round(o_totalprice / 1000) AS s FROM orders),
r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM p)
SELECT round((sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)::double), 6) AS roc_auc FROM r"""
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve of a score with many ties."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(c("o_orderstatus") == "F", 1).otherwise(0).alias("label"), F.round(c("o_totalprice") / 1000).alias("score")
    )
    return rounded(roc_auc_op(orders, "score"), "roc_auc", digits=6)


# --- encoding -----------------------------------------------------------------------


@query(
    """WITH s AS (SELECT p_brand, count(*) / (SELECT count(*) FROM part)::double AS share FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN share < 0.04 THEN 'other' ELSE p_brand END AS p_brand FROM part JOIN s USING (p_brand)"""
)
def group_rare_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.group_rare_share(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", 0.04)


@query(
    """WITH s AS (SELECT p_size, count(*) AS n FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN n < 40 THEN 29 ELSE p_size END AS p_size FROM part JOIN s USING (p_size)"""
)
def group_rare_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.group_rare_count(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", 40)


@query(
    """WITH b AS (SELECT o_orderkey, o_orderpriority, o_custkey, ('0x' || substr(md5(o_orderkey::varchar || '42'), 1, 8))::bigint % 100 AS b FROM orders),
t AS (SELECT * FROM b WHERE b < 60),
fp AS (SELECT o_orderpriority, count(*) / (SELECT count(*) FROM t)::double AS f FROM t GROUP BY 1),
fc AS (SELECT o_custkey, count(*) / (SELECT count(*) FROM t)::double AS f FROM t GROUP BY 1)
SELECT o_orderkey, round(fp.f, 6) AS o_orderpriority, round(fc.f, 6) AS o_custkey FROM b LEFT JOIN fp USING (o_orderpriority) LEFT JOIN fc USING (o_custkey) WHERE b.b >= 80"""
)
def frequency_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training shares applied to the test part; unseen customers become null."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    train, _, test = sampling.split3(orders, "o_orderkey", 42)
    encoded = encoding.FrequencyEncoding.fit(train, ["o_orderpriority", "o_custkey"]).apply(test)
    return rounded(encoded, "o_orderpriority", "o_custkey", digits=6)
