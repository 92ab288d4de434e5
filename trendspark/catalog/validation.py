"""Expectation and check queries."""

from __future__ import annotations

from datetime import datetime
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import VIDEOS_SQL, query, rounded, table, videos
from trendspark.catalog.core import _DATED_SQL, dated_videos
from trendspark.functions.text import literal_list_length
from trendspark.operators import checks
from trendspark.operators import expectations as expect
from trendspark.session import c, durable

_NO_SAMPLE = 'cast(NULL AS varchar) AS sample'


def _expect_sql(dimension: str, check: str, column: str, bad: str, source: str, sample: str | None = None, size: int = 3) -> str:
    """Result row of a row-level expectation, with the first unexpected values as text."""
    value = sample or f"cast({column} AS varchar)"
    shown = f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT {value} AS v FROM {source} WHERE ({bad}) AND {value} IS NOT NULL ORDER BY v LIMIT {size}))"
    return f"""SELECT '{dimension}' AS dimension, '{check}' AS "check", '{column}' AS "column", count(*) FILTER ({bad}) = 0 AS passed,
count(*) FILTER ({bad}) AS unexpected_count, {shown} AS sample FROM {source}"""


_LABELLED = "(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query(" UNION ALL ".join(_expect_sql("Completeness", "not_null", n, f"{n} IS NULL", _LABELLED) for n in ("doc_id", "lang", "quality", "toxic")))
def expect_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return expect.run_suite(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"), expect.not_null("doc_id", "lang", "quality", "toxic"))


@query(
    _expect_sql("Accuracy", "between", "c_nationkey", "c_nationkey < 1 OR c_nationkey > 20", "customer")
    + " UNION ALL "
    + _expect_sql("Accuracy", "between", "c_acctbal", "c_acctbal < 0", "customer")
)
def expect_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.run_suite(table(spark, sf_dir, "customer"), [expect.between("c_nationkey", 1, 20), expect.between("c_acctbal", 0)])


@query(
    _expect_sql("Accuracy", "matches_regex", "p_brand", "NOT regexp_matches(p_brand, '^Brand#1\\d$')", "part")
    + " UNION ALL "
    + _expect_sql("Accuracy", "matches_regex", "p_name", "NOT regexp_matches(p_name, '^\\w+ \\w+')", "part")
)
def expect_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.run_suite(table(spark, sf_dir, "part"), [expect.matches("p_brand", r"^Brand#1\d$"), expect.matches("p_name", r"^\w+ \w+")])


def _unique_sql(label: str, cols: str, source: str) -> str:
    return f"""SELECT 'Uniqueness' AS dimension, 'unique' AS "check", '{label}' AS "column", coalesce(sum(n), 0) = 0 AS passed,
cast(coalesce(sum(n), 0) AS bigint) AS unexpected_count, {_NO_SAMPLE} FROM (SELECT count(*) AS n FROM {source} GROUP BY {cols} HAVING count(*) > 1)"""


@query(_unique_sql("l_orderkey", "l_orderkey", "lineitem") + " UNION ALL " + _unique_sql("compound", "l_orderkey, l_linenumber, l_partkey", "lineitem"))
def expect_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return expect.run_suite(lines, [expect.unique("l_orderkey"), expect.unique("l_orderkey", "l_linenumber", "l_partkey")])


@query(
    f"""WITH have AS (SELECT column_name AS n FROM (DESCRIBE customer)), want(n) AS (VALUES ('c_custkey'), ('c_name'), ('c_phone'))
SELECT 'Consistency' AS dimension, 'column_set' AS "check", 'table' AS "column", count(*) = 0 AS passed, count(*) AS unexpected_count, {_NO_SAMPLE} FROM (
  (SELECT n FROM have EXCEPT SELECT n FROM want) UNION ALL (SELECT n FROM want EXCEPT SELECT n FROM have))"""
)
def expect_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.run_suite(table(spark, sf_dir, "customer"), [expect.column_set(["c_custkey", "c_name", "c_phone"])])


@query(
    _expect_sql("Consistency", "in_set", "c_mktsegment", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "customer")
    + " UNION ALL "
    + _expect_sql("Consistency", "in_set", "c_nationkey", "c_nationkey NOT IN (0, 1, 2)", "customer")
)
def expect_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = [expect.in_set("c_mktsegment", ["BUILDING", "MACHINERY"]), expect.in_set("c_nationkey", [0, 1, 2])]
    return expect.run_suite(table(spark, sf_dir, "customer"), suite)


@query(
    f"""SELECT 'Distribution' AS dimension, 'row_count' AS "check", 'table' AS "column", count(*) BETWEEN 100 AND 500000 AS passed,
CASE WHEN count(*) BETWEEN 100 AND 500000 THEN 0 ELSE 1 END::bigint AS unexpected_count, {_NO_SAMPLE} FROM lineitem"""
)
def expect_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.run_suite(table(spark, sf_dir, "lineitem"), [expect.row_count(100, 500_000)])


@query(
    " UNION ALL ".join(
        f"""SELECT 'Distribution' AS dimension, 'median' AS "check", '{n}' AS "column", quantile_cont({n}, 0.5) >= {lo} AS passed,
CASE WHEN quantile_cont({n}, 0.5) >= {lo} THEN 0 ELSE 1 END::bigint AS unexpected_count, {_NO_SAMPLE} FROM lineitem"""
        for n, lo in (("l_quantity", 1), ("l_extendedprice", 1000000))
    )
)
def expect_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.run_suite(table(spark, sf_dir, "lineitem"), [expect.median_at_least("l_quantity", 1), expect.median_at_least("l_extendedprice", 1000000)])


@query(
    _expect_sql("Structure", "length_between", "p_name", "length(p_name) < 9 OR length(p_name) > 11", "part")
    + " UNION ALL "
    + _expect_sql("Structure", "length_between", "p_brand", "length(p_brand) < 7 OR length(p_brand) > 8", "part")
)
def expect_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.run_suite(table(spark, sf_dir, "part"), [expect.length_between("p_name", 9, 11), expect.length_between("p_brand", 7, 8)])


@query(
    f"""WITH {VIDEOS_SQL}, f AS (SELECT *, view_count > 300000 AS big FROM videos)
"""
    + " UNION ALL ".join(
        [
            *[_expect_sql("Completeness", "not_null", n, f"{n} IS NULL", "f") for n in ("video_id", "view_count", "comment_count")],
            _expect_sql("Accuracy", "between", "likes", "likes < 0", "f"),
            _expect_sql("Accuracy", "between", '"categoryId"', '"categoryId" < 1 OR "categoryId" > 44', "f").replace("'\"categoryId\"'", "'categoryId'"),
            _unique_sql("video_id", "video_id", "f"),
            _unique_sql("compound", 'video_id, "channelId", likes', "f"),
            f"""SELECT 'Consistency', 'column_set', 'table', true, 0::bigint, {_NO_SAMPLE}""",
            f"""SELECT 'Distribution', 'row_count', 'table', count(*) BETWEEN 100 AND 500000, CASE WHEN count(*) BETWEEN 100 AND 500000 THEN 0 ELSE 1 END::bigint, {_NO_SAMPLE} FROM f""",
            f"""SELECT 'Distribution', 'median', 'view_count', quantile_cont(view_count, 0.5) >= 1, CASE WHEN quantile_cont(view_count, 0.5) >= 1 THEN 0 ELSE 1 END::bigint, {_NO_SAMPLE} FROM f""",
            _expect_sql("Structure", "length_between", "video_id", "length(video_id) <> 11", "f"),
        ]
    )
)
def run_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole suite: row-level expectations in one pass, table-level ones beside it."""
    vids = durable(videos(spark, sf_dir), "videos")
    suite = [
        *expect.not_null("video_id", "view_count", "comment_count"),
        expect.between("likes", 0),
        expect.between("categoryId", *expect.CATEGORY_RANGE),
        expect.unique("video_id"),
        expect.unique("video_id", "channelId", "likes"),
        expect.column_set(vids.columns),
        expect.row_count(*expect.ROW_COUNT_RANGE),
        expect.median_at_least("view_count", 1),
        expect.length_between("video_id", 11, 11),
    ]
    return expect.run_suite(vids, suite)


# --- statistical and cross-column checks ------------------------------------------------


def _row(dimension: str, check: str, column: str, passed: str, count: str, detail: str, source: str = "") -> str:
    return f"""SELECT '{dimension}' AS dimension, '{check}' AS "check", '{column}' AS "column", {passed} AS passed,
cast({count} AS bigint) AS issue_count, {detail} AS detail {source}"""


def _zero(dimension: str, check: str, column: str, bad: str, source: str) -> str:
    return _row(dimension, check, column, f"count(*) FILTER ({bad}) = 0", f"count(*) FILTER ({bad})", "cast(NULL AS varchar)", f"FROM {source}")


@query(
    " UNION ALL ".join(
        [
            _row("Consistency", "schema", "s_phone", "false", "1", "'missing'"),
            _row("Consistency", "schema", "s_nationkey", "true", "1", "'extra'"),
            _row("Consistency", "schema", "s_acctbal", "false", "1", "'expected int, got double'"),
        ]
    )
)
def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {"s_suppkey": "bigint", "s_acctbal": "int", "s_name": "string"}
    return checks.check_schema(table(spark, sf_dir, "supplier"), ["s_suppkey", "s_name", "s_acctbal", "s_phone"], types)


@query(
    """WITH v AS (SELECT lang || '-' || upper(substr(source, 1, 2)) AS code, lower(lang) AS base FROM documents),
bad AS (SELECT code, count(*) AS n FROM v WHERE base NOT IN ('en', 'fr') GROUP BY 1)
SELECT 'Consistency' AS dimension, 'language' AS "check", 'code' AS "column", coalesce(sum(n), 0) = 0 AS passed, cast(coalesce(sum(n), 0) AS bigint) AS issue_count,
  (SELECT string_agg(code, ', ' ORDER BY code) FROM (SELECT code FROM bad ORDER BY code LIMIT 5)) AS detail FROM bad"""
)
def check_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.concat("lang", F.lit("-"), F.upper(F.substring("source", 1, 2))).alias("code"), "lang")
    known = docs.select("lang").distinct().filter(c("lang").isin("en", "fr"))
    return checks.check_language(docs.select("code"), "code", known)


_BLANK_SOURCE = "(SELECT CASE WHEN lang = 'en' THEN '   ' ELSE source END AS source, text FROM documents)"


@query(
    " UNION ALL ".join(_zero("Completeness", "blank_strings", n, f"regexp_matches({n}, '^\\s*$')", _BLANK_SOURCE) for n in ("source", "text"))
)
def check_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.when(c("lang") == "en", "   ").otherwise(c("source")).alias("source"), "text")
    return checks.check_blank(docs, ["source", "text", "not_there"])


@query(
    f"WITH {_DATED_SQL} "
    + " UNION ALL ".join(
        _zero("Accuracy", "cross_column", name, bad, "dated")
        for name, bad in (
            ("trending_without_date", "is_trending = 1 AND trending_date IS NULL"),
            ("disabled_with_comments", "comments_disabled AND comment_count IS DISTINCT FROM 0"),
            ("likes_above_views", "likes > view_count"),
            ("age_restricted_with_comments", "rating = 'ytAgeRestricted' AND NOT comments_disabled"),
        )
    )
)
def check_cross_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_cross_column(dated_videos(spark, sf_dir))


_NOW = datetime(1998, 6, 1)


@query(
    """SELECT 'o_orderdate' AS "column", count(*) FILTER (o_orderdate > TIMESTAMP '1998-06-01') AS future FROM orders
UNION ALL SELECT 'text_date', count(*) FILTER (o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1998-06-01') FROM orders"""
)
def future_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates after a given moment; text that is no date is skipped."""
    text = F.when(c("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return checks.future_counts(table(spark, sf_dir, "orders").select("o_orderdate", text.alias("text_date")), ["o_orderdate", "text_date"], _NOW)


@query(" UNION ALL ".join(_zero("Timeliness", "no_future_dates", n, f"{n} > TIMESTAMP '1998-06-01'", "lineitem") for n in ("l_shipdate",)))
def check_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_future(table(spark, sf_dir, "lineitem").select("l_shipdate"), ["l_shipdate", "not_there"], _NOW)


_SHIPPED_SQL = """shipped AS (SELECT o_orderdate, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'unknown' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship,
  CASE WHEN l_linenumber > 2 THEN l_shipdate END AS d FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), c("o_orderkey") == c("l_orderkey"))
    ship = F.when(c("l_linenumber") == 2, "unknown").when(c("l_linenumber") > 2, F.date_format("l_shipdate", "yyyy-MM-dd"))
    return joined.select("o_orderdate", ship.alias("ship"))


@query(
    f"""WITH {_SHIPPED_SQL}
SELECT count(*) FILTER (d::date < o_orderdate::date) AS reversed, count(*) FILTER (d IS NULL) AS skipped, count(*) FILTER (ship = 'unknown') AS unparseable FROM shipped"""
)
def date_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.date_order(_shipped(spark, sf_dir), "o_orderdate", "ship")


@query(
    f"""WITH {_SHIPPED_SQL}
SELECT 'Timeliness' AS dimension, 'date_order' AS "check", 'o_orderdate,ship' AS "column", count(*) FILTER (d::date < o_orderdate::date) = 0 AS passed,
count(*) FILTER (d::date < o_orderdate::date) AS issue_count,
'skipped=' || count(*) FILTER (d IS NULL) || ', unparseable=' || count(*) FILTER (ship = 'unknown') AS detail FROM shipped
UNION ALL SELECT 'Timeliness', 'date_order', 'o_orderdate,not_there', true, 0, 'column not found'"""
)
def check_date_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = _shipped(spark, sf_dir)
    return checks.check_date_order(shipped, "o_orderdate", "ship").unionByName(checks.check_date_order(shipped, "o_orderdate", "not_there"))


def _iqr_sql(name: str, source: str, k: float) -> str:
    bad = f"{name} < q1 - {k} * (q3 - q1) OR {name} > q3 + {k} * (q3 - q1)"
    return _zero("Outliers", "outliers_iqr", name, bad, f"{source}, (SELECT quantile_cont({name}, 0.25) AS q1, quantile_cont({name}, 0.75) AS q3 FROM {source})")


@query(
    " UNION ALL ".join([_iqr_sql("l_extendedprice", "lineitem", 0.5), _iqr_sql("l_discount", "lineitem", 1.5)])
    + " UNION ALL "
    + _row("Outliers", "outliers_iqr", "constant", "true", "0", "'IQR=0, skipped'")
)
def check_outliers_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_discount", F.lit(5).alias("constant"))
    few = checks.check_outliers_iqr(lines, ["l_extendedprice"], 0.5)
    return few.unionByName(checks.check_outliers_iqr(lines, ["l_discount", "constant", "not_there"], 1.5))


def _z_sql(name: str, source: str, z: float) -> str:
    return _zero("Outliers", "outliers_zscore", name, f"abs({name} - m) / s > {z}", f"{source}, (SELECT avg({name}) AS m, stddev_samp({name}) AS s FROM {source})")


@query(_z_sql("l_extendedprice", "lineitem", 2.0) + " UNION ALL " + _z_sql("l_quantity", "lineitem", 2.0))
def check_outliers_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_outliers_z(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"], 2.0)


def _dominance_sql(name: str, limit: float) -> str:
    return f"""SELECT 'Distribution' AS dimension, 'dominance' AS "check", '{name}' AS "column", NOT max(n) / sum(n)::double > {limit} AS passed,
CASE WHEN max(n) / sum(n)::double > {limit} THEN 1 ELSE 0 END::bigint AS issue_count, printf('top_share=%.4f', max(n) / sum(n)::double) AS detail
FROM (SELECT count(*) AS n FROM lineitem WHERE {name} IS NOT NULL GROUP BY {name})"""


@query(_dominance_sql("l_returnflag", 0.2) + " UNION ALL " + _dominance_sql("l_linenumber", 0.8))
def check_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return checks.check_dominance(lines, "l_returnflag", 0.2).unionByName(checks.check_dominance(lines, "l_linenumber", 0.8))


@query(
    " UNION ALL ".join(
        _row("Distribution", "variance", n, f"NOT stddev_samp({e}) = 0", f"CASE WHEN stddev_samp({e}) = 0 THEN 1 ELSE 0 END", "cast(NULL AS varchar)", "FROM lineitem")
        for n, e in (("l_quantity", "l_quantity"), ("constant", "5 + 0 * l_quantity"))
    )
)
def check_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_variance(table(spark, sf_dir, "lineitem").select("l_quantity", F.lit(5.0).alias("constant")), ["l_quantity", "constant"])


_TOXIC_SHARE = "greatest(count(*) FILTER (toxic = 0), count(*) FILTER (toxic = 1)) / count(toxic)::double"


@query(
    _row("Distribution", "class_imbalance", "toxic", f"NOT {_TOXIC_SHARE} > 0.6", f"CASE WHEN {_TOXIC_SHARE} > 0.6 THEN 1 ELSE 0 END", f"printf('dominant_share=%.4f', {_TOXIC_SHARE})", "FROM labels")
    + " UNION ALL "
    + _row("Distribution", "class_imbalance", "kind", "false", "count(*) FILTER (doc_id % 3 = 2)", "'non-binary values'", "FROM labels")
)
def check_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("kind", c("doc_id") % 3)
    return checks.check_imbalance(labels, "toxic", 0.6).unionByName(checks.check_imbalance(labels, "kind"))


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_tax"), ("l_extendedprice", "l_tax")]


def _corr_row(method: str, a: str, b: str, expr: str, source: str, limit: float) -> str:
    r = f"({expr})"
    return _row("Relationships", f"correlation_{method}", f"{a},{b}", f"NOT abs({r}) > {limit}", f"CASE WHEN abs({r}) > {limit} THEN 1 ELSE 0 END", f"printf('r=%.2f', {r})", source)


def _rank_sql(col: str) -> str:
    return f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0"


@query(
    " UNION ALL ".join(_corr_row("pearson", a, b, f"corr({a}, {b})", "FROM lineitem", 0.6) for a, b in _PAIRS)
    + " UNION ALL "
    + _corr_row("spearman", "l_quantity", "l_extendedprice", "corr(ra, rb)", f"FROM (SELECT {_rank_sql('l_quantity')} AS ra, {_rank_sql('l_extendedprice')} AS rb FROM lineitem)", 0.6)
)
def check_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    linear = checks.check_correlation(lines, ["l_quantity", "l_extendedprice", "l_tax", "not_there"], 0.6)
    return linear.unionByName(checks.check_correlation(lines, ["l_quantity", "l_extendedprice"], 0.6, "spearman"))


@query(
    " UNION ALL ".join(
        _row("Relationships", "skew", n, f"NOT abs(skewness({n})) > 0.1", f"CASE WHEN abs(skewness({n})) > 0.1 THEN 1 ELSE 0 END", f"printf('skew=%.2f', skewness({n}))", "FROM lineitem")
        for n in ("l_extendedprice", "l_discount")
    )
)
def check_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_skew(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_discount"], 0.1)


_LISTED_SQL = """n AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1),
listed AS (SELECT o_orderkey, coalesce(lines, 0) AS lines, o_orderkey % 10 = 0 AS broken, o_orderkey % 10 = 1 AS off FROM orders LEFT JOIN n ON o_orderkey = l_orderkey)"""


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as list text: mostly right, some unparseable, some miscounted."""
    item = F.concat(
        F.lit("{'title': 'it\\'s part "), c("l_partkey").cast("string"), F.lit("', 'seen': "), F.when(c("l_tax") > 0.04, "True").otherwise("None"), F.lit("}")
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ", "), F.lit("]")).alias("chapters"), F.count(F.lit(1)).alias("lines"))
    joined = table(spark, sf_dir, "orders").join(lines, c("o_orderkey") == c("l_orderkey"), "left")
    kind = c("o_orderkey") % 10
    return joined.select(
        "o_orderkey",
        F.when(kind == 0, "[{broken").otherwise(c("chapters")).alias("chapters"),
        (F.coalesce("lines", F.lit(0)) + F.when(kind == 1, 1).otherwise(0)).alias("chapter_count"),
    )


@query(f"WITH {_LISTED_SQL} SELECT o_orderkey, cast(CASE WHEN broken THEN -1 ELSE lines END AS int) AS list_length FROM listed")
def list_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of serialised lists; blank is 0 and unparseable -1."""
    return _listed(spark, sf_dir).select("o_orderkey", literal_list_length(c("chapters")).alias("list_length"))


@query(
    f"""WITH {_LISTED_SQL}
SELECT 'Referential Integrity' AS dimension, 'count_matches' AS "check", 'chapter_count,chapters' AS "column", count(*) FILTER (broken OR off) = 0 AS passed,
count(*) FILTER (broken OR off) AS issue_count, 'unparseable=' || count(*) FILTER (broken) || ', mismatch=' || count(*) FILTER (off) AS detail FROM listed"""
)
def check_count_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_count_matches(_listed(spark, sf_dir), "chapter_count", "chapters")


_ALL_NUMERIC = ["view_count", "likes", "comment_count"]


def _all_checks_sql() -> str:
    """The checks of one table, each as in its own query."""
    cross = (
        ("trending_without_date", "is_trending = 1 AND trending_date IS NULL"),
        ("disabled_with_comments", "comments_disabled AND comment_count IS DISTINCT FROM 0"),
        ("likes_above_views", "likes > view_count"),
        ("age_restricted_with_comments", "rating = 'ytAgeRestricted' AND NOT comments_disabled"),
    )
    parts = [_zero("Completeness", "blank_strings", "video_id", "regexp_matches(video_id, '^\\s*$')", "dated")]
    parts += [_zero("Accuracy", "cross_column", name, bad, "dated") for name, bad in cross]
    for name in ("publishedAt", "trending_date"):
        parts.append(_zero("Timeliness", "no_future_dates", name, f"\"{name}\"::timestamp > TIMESTAMP '{_NOW:%Y-%m-%d}'", "dated"))
    before = "count(*) FILTER (trending_date::date < \"publishedAt\"::date)"
    skipped = "'skipped=' || count(*) FILTER (trending_date IS NULL OR \"publishedAt\" IS NULL) || ', unparseable=0'"
    parts.append(_row("Timeliness", "date_order", "publishedAt,trending_date", f"{before} = 0", before, skipped, "FROM dated"))
    for n in _ALL_NUMERIC:
        parts += [_iqr_sql(n, "dated", 1.5), _z_sql(n, "dated", 3.0)]
        parts.append(_row("Distribution", "variance", n, f"NOT stddev_samp({n}) = 0", f"CASE WHEN stddev_samp({n}) = 0 THEN 1 ELSE 0 END", "cast(NULL AS varchar)", "FROM dated"))
        skewed = f"abs(skewness({n})) > 0.6"
        parts.append(_row("Relationships", "skew", n, f"NOT {skewed}", f"CASE WHEN {skewed} THEN 1 ELSE 0 END", f"printf('skew=%.2f', skewness({n}))", "FROM dated"))
    share = "greatest(count(*) FILTER (is_trending = 0), count(*) FILTER (is_trending = 1)) / count(is_trending)::double"
    parts.append(_row("Distribution", "class_imbalance", "is_trending", f"NOT {share} > 0.9", f"CASE WHEN {share} > 0.9 THEN 1 ELSE 0 END", f"printf('dominant_share=%.4f', {share})", "FROM dated"))
    top = "max(n) / sum(n)::double"
    parts.append(_row("Distribution", "dominance", "categoryId", f"NOT {top} > 0.8", f"CASE WHEN {top} > 0.8 THEN 1 ELSE 0 END", f"printf('top_share=%.4f', {top})", 'FROM (SELECT count(*) AS n FROM dated WHERE "categoryId" IS NOT NULL GROUP BY "categoryId")'))
    for a, b in combinations(_ALL_NUMERIC, 2):
        parts.append(_corr_row("pearson", a, b, f"corr({a}, {b})", "FROM dated", 0.6))
        ranked = f"FROM (SELECT {_rank_sql(a)} AS ra, {_rank_sql(b)} AS rb FROM dated WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        parts.append(_corr_row("spearman", a, b, "corr(ra, rb)", ranked, 0.6))
    return f"WITH {_DATED_SQL} " + " UNION ALL ".join(parts)


@query(_all_checks_sql())
def run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the video table, fused where possible."""
    return checks.run_checks(durable(dated_videos(spark, sf_dir), "dated"), _ALL_NUMERIC, ["video_id"], ["publishedAt", "trending_date"], _NOW)


@query(
    f"WITH {_DATED_SQL}, checks(dimension, ok) AS ("
    + " UNION ALL ".join(
        [
            "SELECT 'Accuracy', count(*) FILTER ((is_trending = 1 AND trending_date IS NULL) OR (comments_disabled AND comment_count IS DISTINCT FROM 0) OR likes > view_count OR (rating = 'ytAgeRestricted' AND NOT comments_disabled)) = 0 FROM dated",
            "SELECT 'Timeliness', count(*) FILTER (\"publishedAt\" > TIMESTAMP '1998-06-01') = 0 FROM dated",
            "SELECT 'Timeliness', count(*) FILTER (trending_date::date < \"publishedAt\"::date) = 0 FROM dated",
            "SELECT 'Distribution', stddev_samp(likes) <> 0 AND stddev_samp(view_count) <> 0 FROM dated",
            "SELECT 'Relationships', NOT abs(corr(likes, view_count)) > 0.6 FROM dated",
        ]
    )
    + """), t AS (SELECT dimension, count(*) FILTER (ok) AS passed, count(*) AS total FROM checks GROUP BY ROLLUP (dimension))
SELECT coalesce(dimension, 'TOTAL') AS dimension, passed, total, round(passed * 100.0 / total, 4) AS success_pct FROM t"""
)
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = durable(dated_videos(spark, sf_dir), "dated")
    found = checks.check_cross_column(vids)
    found = found.unionByName(checks.check_future(vids, ["publishedAt"], _NOW))
    found = found.unionByName(checks.check_date_order(vids, "publishedAt", "trending_date"))
    found = found.unionByName(checks.check_variance(vids, ["likes", "view_count"]))
    found = found.unionByName(checks.check_correlation(vids, ["likes", "view_count"], 0.6))
    return rounded(checks.scorecard(found), "success_pct")


def _summary_lines() -> str:
    parts = [
        "SELECT 'shape' AS section, 'table' AS name, 'rows' AS metric, count(*)::double AS value FROM v",
        "SELECT 'shape', 'table', 'columns', 5.0",
        "SELECT 'target', toxic_text, 'rows', count(*)::double FROM v GROUP BY 2",
        "SELECT 'target', toxic_text, 'pct', count(*) * 100 / (SELECT count(*) FROM v)::double FROM v GROUP BY 2",
        "SELECT 'nulls', 'quality', 'nulls', count(*) FILTER (quality IS NULL)::double FROM v",
        "SELECT 'nulls', 'toxic', 'nulls', count(*) FILTER (toxic IS NULL)::double FROM v",
    ]
    for name in ("doc_id", "n_chars", "quality", "toxic"):
        parts += [f"SELECT 'numeric', '{name}', '{m}', {f}({name})::double FROM v" for m, f in (("mean", "avg"), ("min", "min"), ("max", "max"))]
    return " UNION ALL ".join(parts)


@query(
    f"""WITH v AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic, coalesce(cast(l.toxic AS varchar), 'null') AS toxic_text FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
s AS ({_summary_lines()}) SELECT section, name, metric, round(value, 4) AS value FROM s"""
)
def quick_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(checks.quick_summary(docs, "toxic"), "value")
