"""Profiling, dashboard, ranking and sampling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import LABELLED_SQL, VIDEOS_SQL, labelled, query, rounded, table, videos
from trendspark.functions import times
from trendspark.operators import aggregates, ranking, sampling
from trendspark.operators.quantiles import quantiles
from trendspark.session import c, durable


@query("SELECT event_type AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM events)::double, 4) AS share FROM events GROUP BY 1")
def value_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.value_shares(table(spark, sf_dir, "events"), "event_type"), "share")


@query(
    f"""WITH {LABELLED_SQL}
SELECT quality AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM labelled)::double, 4) AS share FROM labelled GROUP BY 1"""
)
def value_shares_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.value_shares(labelled(spark, sf_dir), "quality", keep_null=True), "share")


@query(
    f"""WITH {LABELLED_SQL}, n AS (
SELECT 'quality' AS "column", count(*) - count(quality) AS nulls FROM labelled UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM labelled
UNION ALL SELECT 'short_text', count(*) FILTER (length(text) >= 500) FROM labelled)
SELECT * FROM n WHERE nulls > 0 ORDER BY nulls DESC, "column" LIMIT 10"""
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(spark, sf_dir).withColumn("short_text", F.when(F.length("text") < 500, c("text")))
    return aggregates.null_counts(df, 10)


def _summary_sql(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "column", count({name}) AS n, round(avg({name}), 4) AS mean, round(stddev_samp({name}), 4) AS std, round(min({name})::double, 4) AS min,
round(quantile_cont({name}, 0.25), 4) AS q25, round(quantile_cont({name}, 0.5), 4) AS median, round(quantile_cont({name}, 0.75), 4) AS q75, round(max({name})::double, 4) AS max FROM {source}"""


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SUMMARY = ["mean", "std", "min", "q25", "median", "q75", "max"]


@query(" UNION ALL ".join(_summary_sql(n, "lineitem") for n in _MEASURES))
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.numeric_summary(table(spark, sf_dir, "lineitem"), _MEASURES), *_SUMMARY)


@query("SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def row_col_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.row_col_counts(table(spark, sf_dir, "lineitem"))


@query(f"""WITH {VIDEOS_SQL} SELECT "categoryId", round(avg(is_trending), 4) AS rate, count(*) AS n FROM videos GROUP BY 1""")
def target_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.target_rate(videos(spark, sf_dir), "categoryId", "is_trending"), "rate")


@query(
    """SELECT user_id, round(avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END), 4) AS rate FROM events GROUP BY 1
ORDER BY avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) DESC, user_id LIMIT 15"""
)
def top_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", F.when(c("event_type") == "click", 1).otherwise(0).alias("hit"))
    return rounded(aggregates.top_rate(events, "user_id", "hit", 15), "rate")


@query(
    """SELECT p_brand, count(*) FILTER (p_size < 25) AS target_0, count(*) FILTER (p_size >= 25) AS target_1 FROM part GROUP BY 1
ORDER BY count(*) DESC, p_brand LIMIT 10"""
)
def group_by_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_brand", (c("p_size") >= 25).cast("int").alias("big"))
    return aggregates.group_by_target_counts(part, "p_brand", "big")


@query(
    """SELECT isodow(ts) >= 6 AS is_weekend, round(count(*) FILTER (event_type = 'click') / count(*)::double, 4) AS share_0,
round(count(*) FILTER (event_type <> 'click') / count(*)::double, 4) AS share_1 FROM events GROUP BY 1"""
)
def crosstab_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        (times.weekday(c("ts")) >= 5).alias("is_weekend"), (c("event_type") != "click").cast("int").alias("other")
    )
    return rounded(aggregates.crosstab_share(events, "is_weekend", "other", [0, 1]), "share_0", "share_1")


@query(
    f"""WITH {VIDEOS_SQL}
SELECT "channelId", count(video_id) AS video_count, cast(sum(is_trending) AS bigint) AS trending_count, round(avg(is_trending), 4) AS trending_rate,
round(avg(view_count), 4) AS avg_views, arg_min(is_verified, video_id) AS is_verified FROM videos GROUP BY 1"""
)
def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A numeric order keeps the aggregate on the hash path.
    vids = videos(spark, sf_dir).withColumn("_row", c("video_id").cast("bigint"))
    return rounded(aggregates.channel_stats(vids, order="_row"), "trending_rate", "avg_views")


_DAYS_SQL = ", ".join(
    f"round(avg(hit) FILTER (isodow(ts) = {i + 1}), 4) AS \"{d}\"" for i, d in enumerate(times.DAY_LABELS)
)


@query(
    f"""WITH e AS (SELECT ts, CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END AS hit FROM events)
SELECT cast(hour(ts) AS int) AS "row", {_DAYS_SQL} FROM e GROUP BY 1"""
)
def pivot_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click rate by hour and weekday."""
    events = table(spark, sf_dir, "events").select("ts", F.when(c("event_type") == "click", 1).otherwise(0).alias("hit"))
    grid = aggregates.pivot_rate(events, F.hour("ts"), times.weekday(c("ts")), "hit", dict(enumerate(times.DAY_LABELS)))
    return rounded(grid, *times.DAY_LABELS)


@query(
    f"""WITH {VIDEOS_SQL}
SELECT cast(month("publishedAt") AS int) AS period, round(avg(is_trending), 4) AS trending_rate, count(video_id) AS video_count FROM videos GROUP BY 1"""
)
def period_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregates.period_summary(videos(spark, sf_dir), F.month("publishedAt"), "is_trending", "video_id")
    return rounded(out, "trending_rate")


@query(
    f"""WITH {VIDEOS_SQL}
SELECT count(*) AS total_videos, round(avg(is_trending), 4) AS trending_rate, round(avg(exp(ln(view_count + 1.0)) - 1), 2) AS avg_views,
round(avg(comment_count / (view_count + 1)::double), 6) AS avg_comment_rate FROM videos"""
)
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = videos(spark, sf_dir).withColumn("comment_rate", c("comment_count") / (c("view_count") + 1)).withColumn("view_count", F.log1p("view_count"))
    out = rounded(aggregates.kpis(vids, "is_trending", "view_count", "comment_rate"), "trending_rate")
    return rounded(rounded(out, "avg_views", digits=2), "avg_comment_rate", digits=6)


@query(
    """SELECT l_returnflag, 'l_extendedprice' AS "column", round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'l_discount', round(quantile_cont(l_discount, 0.5), 4) FROM lineitem GROUP BY 1"""
)
def group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.group_median(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_extendedprice", "l_discount"]), "median")


@query(f"WITH {VIDEOS_SQL} SELECT round((1 - avg(is_trending)) / avg(is_trending), 4) AS ratio FROM videos")
def class_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.class_ratio(videos(spark, sf_dir), "is_trending"), "ratio")


# --- ranking ------------------------------------------------------------------------

_USERS_SQL = "users AS (SELECT user_id, cast(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS bigint) AS clicks FROM events GROUP BY 1)"


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.sum(F.when(c("event_type") == "click", 1).otherwise(0))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(hit.alias("clicks"))


@query(
    f"""WITH {_USERS_SQL}
SELECT user_id, clicks, cast(row_number() OVER w AS bigint) AS rank, round(row_number() OVER w * 100.0 / count(*) OVER (), 4) AS cum_pct_keys,
round(sum(clicks) OVER w * 100.0 / sum(clicks) OVER (), 4) AS cum_pct_value FROM users WINDOW w AS (ORDER BY clicks DESC, user_id ROWS UNBOUNDED PRECEDING)"""
)
def user_lorenz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.lorenz(_users(spark, sf_dir), "user_id", "clicks"), "cum_pct_keys", "cum_pct_value")


@query(
    f"""WITH {_USERS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY clicks DESC, user_id) AS rk, count(*) OVER () AS n FROM users)
SELECT count(*) FILTER (rk <= floor(n * 0.1)) AS top_keys, round(sum(clicks) FILTER (rk <= floor(n * 0.1)) * 100.0 / sum(clicks), 4) AS share_pct FROM r"""
)
def top_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.top_share(_users(spark, sf_dir), "user_id", "clicks", 0.1), "share_pct")


@query(
    f"""WITH {VIDEOS_SQL}, p AS (SELECT cast(quarter("publishedAt") AS int) AS period, avg(is_trending) AS r FROM videos GROUP BY 1),
d AS (SELECT period, r, r - lag(r) OVER (ORDER BY period) AS delta FROM p)
SELECT period, round(r, 4) AS trending_rate, round(delta, 4) AS delta, delta >= 0 AS is_up FROM d"""
)
def period_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = aggregates.period_summary(videos(spark, sf_dir), F.quarter("publishedAt"), "is_trending", "video_id")
    return rounded(ranking.period_delta(quarters, "period", "trending_rate"), "trending_rate", "delta")


@query(
    """WITH g AS (SELECT cast(isodow(ts) - 1 AS int) AS weekday, cast(hour(ts) AS int) AS hour, avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) AS rate FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY weekday ORDER BY rate DESC, hour) AS rn FROM g)
SELECT weekday, hour AS peak, round(rate, 4) AS peak_rate FROM r WHERE rn = 1"""
)
def peak_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        times.weekday(c("ts")).alias("weekday"), F.hour("ts").alias("hour"), F.when(c("event_type") == "click", 1).otherwise(0).alias("hit")
    )
    return rounded(ranking.peak_per_group(events, "weekday", "hour", "hit"), "peak_rate")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 100, ["o_orderkey"])


def _quartiles_sql(by: str = "") -> str:
    group = f"{by}, " if by else ""
    parts = [
        f"SELECT {group}'{n}' AS \"column\", count({n}) AS n, round(quantile_cont({n}, 0.25), 4) AS q25, "
        f"round(quantile_cont({n}, 0.5), 4) AS q50, round(quantile_cont({n}, 0.75), 4) AS q75 FROM lineitem" + (f" GROUP BY {by}" if by else "")
        for n in _MEASURES
    ]
    return " UNION ALL ".join(parts)


def _quartiles(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    """Quartiles by brackets at every size: narrow ones only, so that ranks outside of them are found again."""
    found = quantiles(table(spark, sf_dir, "lineitem"), _MEASURES, [0.25, 0.5, 0.75], by, accuracy=1_000, small_rows=0)
    cells = [c("q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    return rounded(found.select(*by, "column", "n", *cells), "q25", "q50", "q75")


@query(_quartiles_sql())
def quantiles_by_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quartiles(spark, sf_dir, [])


@query(_quartiles_sql("l_linenumber"))
def quantiles_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few groups, each with its own brackets."""
    return _quartiles(spark, sf_dir, ["l_linenumber"])


@query(_quartiles_sql("l_suppkey"))
def quantiles_of_many_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of a few rows each."""
    return _quartiles(spark, sf_dir, ["l_suppkey"])


# --- sampling -----------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::varchar || '42'), o_orderkey LIMIT 3000")
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 3000, "o_orderkey", 42)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::varchar || '42'), o_orderkey LIMIT 3000")
def sample_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sample by narrowing hash prefixes to cells of a hundred rows."""
    return sampling.sample_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 3000, "o_orderkey", 42, cell_rows=100)


@query(
    f"""WITH {VIDEOS_SQL}, p AS (SELECT count(*) AS n FROM videos WHERE is_trending = 1),
neg AS (SELECT *, row_number() OVER (ORDER BY md5(video_id || '42'), video_id) AS rn FROM videos WHERE is_trending = 0)
SELECT video_id, is_trending FROM videos WHERE is_trending = 1 UNION ALL SELECT video_id, is_trending FROM neg, p WHERE rn <= n"""
)
def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = durable(videos(spark, sf_dir).select("video_id", "is_trending"), "videos")
    return sampling.balanced_sample(vids, "is_trending", "video_id", 42)


@query(
    """WITH b AS (SELECT o_orderkey, ('0x' || substr(md5(o_orderkey::varchar || '42'), 1, 8))::bigint % 100 AS b FROM orders)
SELECT o_orderkey, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS part FROM b"""
)
def split_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, validation and test parts, labelled and put back together."""
    parts = sampling.split3(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 42)
    train, val, test = (p.withColumn("part", F.lit(n)) for p, n in zip(parts, ("train", "val", "test"), strict=True))
    return train.unionByName(val).unionByName(test)
