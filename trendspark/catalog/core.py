"""Flagship, projection, filter, join and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import LABELLED_SQL, REGISTRY, VIDEOS_SQL, labelled, query, rounded, table, videos
from trendspark.functions.text import language_base
from trendspark.operators import dedupe, filters, joins, neighbors, projection
from trendspark.operators.aggregates import channel_stats
from trendspark.operators.neighbor_graph import graph_join
from trendspark.operators.ranking import lorenz
from trendspark.operators.transforms import cap_outliers, log_transform
from trendspark.session import c, durable

LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

_FLAGSHIP_VIDEOS = VIDEOS_SQL.replace("FROM lineitem GROUP BY", "FROM deduped GROUP BY")


@query(
    f"""
WITH deduped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn
    FROM lineitem) WHERE rn = 1
), {_FLAGSHIP_VIDEOS},
kept AS (SELECT * FROM videos WHERE likes <= view_count),
logged AS (SELECT "channelId", video_id, is_trending, is_verified, ln(view_count + 1.0) AS lv FROM kept),
b AS (SELECT avg(lv) - 3 * stddev_samp(lv) AS lo, avg(lv) + 3 * stddev_samp(lv) AS hi FROM logged),
stats AS (
  SELECT "channelId", cast(count(video_id) AS bigint) AS video_count, cast(sum(is_trending) AS bigint) AS trending_count,
         avg(least(greatest(lv, lo), hi)) AS avg_views
  FROM logged, b GROUP BY "channelId")
SELECT "channelId", video_count, trending_count, round(avg_views, 4) AS avg_views,
       cast(row_number() OVER w AS bigint) AS rank,
       round(row_number() OVER w * 100.0 / count(*) OVER (), 4) AS cum_pct_keys,
       round(sum(trending_count) OVER w * 100.0 / sum(trending_count) OVER (), 4) AS cum_pct_value
FROM stats WINDOW w AS (ORDER BY trending_count DESC, "channelId" ROWS UNBOUNDED PRECEDING)
"""
)
def channel_lorenz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated lines to videos, filtered, log-scaled and capped, to channel concentration."""
    lines = dedupe.dedupe_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    per_order = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.count("l_linenumber").alias("n_lines"))
    orders = table(spark, sf_dir, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    vids = orders.select(
        "o_orderkey",
        F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("video_id"),
        F.col("o_custkey").alias("channelId"),
        F.floor("o_totalprice").cast("bigint").alias("view_count"),
        (F.coalesce("quantity", F.lit(0.0)) * 500).cast("bigint").alias("likes"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_trending"),
        (F.col("o_custkey") % 7 == 0).alias("is_verified"),
    )
    logged = durable(log_transform(filters.filter_le(vids, "likes", "view_count"), ["view_count"]), "flagship")
    stats = channel_stats(cap_outliers(logged, ["view_count"], "zscore"), order="o_orderkey")
    out = lorenz(stats, "channelId", "trending_count", keep=["video_count", "avg_views"])
    return rounded(out, "avg_views", "cum_pct_keys", "cum_pct_value")


# --- projection -----------------------------------------------------------------


@query("SELECT o_orderkey AS video_id, o_totalprice AS view_count, o_custkey AS likes, o_orderstatus FROM orders")
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")
    return projection.rename_columns(df, {"o_orderkey": "video_id", "o_totalprice": "view_count", "o_custkey": "likes"})


@query("SELECT c_custkey, c_name, true AS is_trending, '2026-04-10' AS trending_date FROM customer")
def add_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.add_metadata(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), True, "2026-04-10")


@query("SELECT s_nationkey AS nationkey, cast(NULL AS varchar) AS mktsegment, s_name AS name, s_suppkey AS key FROM supplier")
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers shaped like customers: a missing column is null, an extra one goes."""
    customer = table(spark, sf_dir, "customer")
    reference = customer.select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("mktsegment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("key")
    )
    supplier = table(spark, sf_dir, "supplier").withColumnsRenamed({"s_suppkey": "key", "s_name": "name", "s_nationkey": "nationkey"})
    return projection.align_columns(supplier, reference.schema)


@query("SELECT p_partkey, p_name, p_size FROM part")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.drop_columns(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_retailprice", "not_there"])


@query("SELECT d.doc_id, coalesce(l.quality, cast(d.n_chars % 2 AS int)) AS flag FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def combine_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(spark, sf_dir).select("doc_id", "quality", (F.col("n_chars") % 2).cast("int").alias("fallback"))
    return projection.combine_first(df, "quality", "fallback", "flag")


@query(
    f"""WITH {VIDEOS_SQL}
SELECT video_id,
       round(CASE WHEN view_count <> 0 THEN likes / view_count::double END, 4) AS like_to_view_ratio,
       round(CASE WHEN view_count <> 0 THEN comment_count / view_count::double END, 6) AS comment_to_view_ratio,
       round(likes / (view_count + 1)::double, 4) AS like_rate
FROM videos"""
)
def engagement_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = projection.engagement_ratios(videos(spark, sf_dir), {"likes": "like_to_view_ratio", "comment_count": "comment_to_view_ratio"})
    df = projection.engagement_ratios(df, {"likes": "like_rate"}, plus_one=True)
    df = rounded(df.select("video_id", "like_to_view_ratio", "comment_to_view_ratio", "like_rate"), "like_to_view_ratio", "like_rate")
    return rounded(df, "comment_to_view_ratio", digits=6)


@query(
    f"""WITH {VIDEOS_SQL}
SELECT video_id, CASE WHEN comment_count > 0 THEN 1 ELSE 0 END AS has_comments, CASE WHEN likes > 0 THEN 1 ELSE 0 END AS has_likes
FROM videos"""
)
def presence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = projection.presence_flags(videos(spark, sf_dir), {"comment_count": "has_comments", "likes": "has_likes"})
    return flagged.select("video_id", "has_comments", "has_likes")


@query("SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns but the key."""
    return projection.select_by_rule(table(spark, sf_dir, "lineitem"), exclude=["l_orderkey"])


# --- filters --------------------------------------------------------------------


@query(f"WITH {VIDEOS_SQL} SELECT video_id, likes, view_count FROM videos WHERE coalesce(likes, 0) <= coalesce(view_count, 0)")
def filter_likes_within_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_le(videos(spark, sf_dir), "likes", "view_count").select("video_id", "likes", "view_count")


@query(
    f"""WITH {VIDEOS_SQL}
SELECT video_id, comment_count, comments_disabled FROM videos
WHERE comment_count IS NULL OR (comment_count >= 0 AND NOT comments_disabled) OR (comment_count = 0 AND comments_disabled)"""
)
def filter_comment_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filters.filter_comment_state(videos(spark, sf_dir), "comment_count", "comments_disabled")
    return out.select("video_id", "comment_count", "comments_disabled")


@query(f"WITH {LABELLED_SQL} SELECT doc_id, lang, quality, toxic FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_nulls(labelled(spark, sf_dir).select("doc_id", "lang", "quality", "toxic"))


@query(
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
WHERE l_extendedprice BETWEEN q1 - 0.25 * (q3 - q1) AND q3 + 0.25 * (q3 - q1)"""
)
def filter_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return filters.filter_iqr(lines, "l_extendedprice", 0.25)


_DATED_SQL = f"""{VIDEOS_SQL},
dated AS (SELECT *, CASE WHEN "categoryId" <> 3 THEN strftime("publishedAt", '%Y-%m-%d') END AS trending_date,
  CASE WHEN "categoryId" = 2 THEN 'ytAgeRestricted' END AS rating FROM videos)"""


def dated_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos with a trending date (missing in category 3) and an age rating (category 2)."""
    return videos(spark, sf_dir).withColumns(
        {
            "trending_date": F.when(F.col("categoryId") != 3, F.date_format("publishedAt", "yyyy-MM-dd")),
            "contentDetails.contentRating.ytRating": F.when(F.col("categoryId") == 2, F.lit("ytAgeRestricted")),
        }
    )


@query(
    f"""WITH {_DATED_SQL}
SELECT 'trending_without_date' AS rule, count(*) FILTER (is_trending = 1 AND trending_date IS NULL) AS violations FROM dated
UNION ALL SELECT 'disabled_with_comments', count(*) FILTER (comments_disabled AND comment_count IS DISTINCT FROM 0) FROM dated
UNION ALL SELECT 'likes_above_views', count(*) FILTER (likes > view_count) FROM dated
UNION ALL SELECT 'age_restricted_with_comments', count(*) FILTER (rating = 'ytAgeRestricted' AND NOT comments_disabled) FROM dated"""
)
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.violations(dated_videos(spark, sf_dir))


# --- joins ----------------------------------------------------------------------


@query("SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; many have none."""
    base = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return joins.enrich_left(base, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")


@query(
    f"""WITH {VIDEOS_SQL},
scraped AS (SELECT video_id, cast(NULL AS boolean) AS comments_disabled, cast(comment_count AS int) AS card_count FROM videos WHERE comment_count = 2
  UNION ALL SELECT video_id, NOT comments_disabled, cast(comment_count AS int) FROM videos WHERE comment_count > 2)
SELECT v.video_id, coalesce(s.comments_disabled, v.comments_disabled) AS comments_disabled, s.card_count
FROM videos v LEFT JOIN scraped s ON v.video_id = s.video_id"""
)
def merge_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page features join by id; the page's comment flag wins over the table's where known."""
    vids = durable(videos(spark, sf_dir).select("video_id", "comments_disabled", "comment_count"), "videos")
    flag = F.when(F.col("comment_count") > 2, ~F.col("comments_disabled"))
    scraped = vids.filter("comment_count >= 2").select("video_id", flag.alias("comments_disabled"), F.col("comment_count").cast("int").alias("card_count"))
    return joins.merge_scraped(vids.drop("comment_count"), scraped, "video_id", ["comments_disabled"])


@query("SELECT d.doc_id, l.quality AS mapped FROM documents d LEFT JOIN labels l USING (doc_id)")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document ids replaced by their label; an id without one becomes null."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return joins.map_lookup(docs, "doc_id", table(spark, sf_dir, "labels"), "quality", "mapped")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def exclude_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.exclude_known(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    """WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10)
SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM top)"""
)
def keep_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose brand is among the ten most frequent."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    top = part.groupBy("p_brand").count().orderBy(F.desc("count"), "p_brand").limit(10).select("p_brand")
    return joins.keep_members(part, "p_brand", top)


_DISTANCE = "list_distance(a.embedding::double[], b.embedding::double[])"


@query(
    f"""WITH d AS (SELECT a.vec_id AS qid, b.vec_id AS bid, {_DISTANCE} AS distance
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, bid) AS rank FROM d)
SELECT qid, bid, round(distance, 4) AS distance, cast(rank AS int) AS rank FROM r WHERE rank <= 5"""
)
def nearest_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest other vectors of every vector."""
    return _five_nearest(spark, sf_dir)


def _five_nearest(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings")
    out = neighbors.knn_join(vecs, vecs, "embedding", 5, "vec_id", "vec_id", exclude_self=True, **options)
    return rounded(out, "distance")


@query(REGISTRY["nearest_neighbors"].sql)
def nearest_neighbors_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over many cells and blocks."""
    return _five_nearest(spark, sf_dir, block_rows=64)


@query()
def approximate_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours found by refining a graph; the tests measure recall on this table."""
    vecs = table(spark, sf_dir, "embeddings")
    return rounded(graph_join(vecs, vecs, "embedding", 5, "vec_id", "vec_id", exclude_self=True), "distance")


# --- sets and de-duplication ----------------------------------------------------


@query(
    """SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
UNION ALL SELECT p_partkey, p_name, p_size FROM part"""
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("key"))
    part = table(spark, sf_dir, "part").select(F.col("p_size").alias("nation"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    return dedupe.union_sources([customer, supplier, part])


@query("SELECT o_custkey AS id FROM orders WHERE o_custkey IS NOT NULL UNION SELECT user_id FROM events WHERE user_id IS NOT NULL")
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return dedupe.known_ids([orders, table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))], "id")


@query(
    """WITH want(name) AS (VALUES ('doc_id'), ('text'), ('lang'), ('title')),
have AS (SELECT column_name AS name FROM (DESCRIBE documents))
SELECT 'missing' AS kind, name AS "column" FROM want WHERE name NOT IN (SELECT name FROM have)
UNION ALL SELECT 'extra', name FROM have WHERE name NOT IN (SELECT name FROM want)"""
)
def schema_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.schema_diff(table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "title"])


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_rows(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1"""
)
def dedupe_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedupe.dedupe_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query("SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedupe_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of every distinct text."""
    return dedupe.dedupe_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"])


@query(
    """WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT count(*) AS "groups", cast(sum(n) AS bigint) AS rows_in_groups, cast(sum(n - 1) AS bigint) AS extra_rows FROM g"""
)
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT doc_id, lang FROM documents WHERE lang NOT IN ('en', 'fr')")
def drop_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose language is not in a given set."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    known = docs.select(language_base(c("lang")).alias("lang")).filter(c("lang").isin("en", "fr")).distinct()
    return joins.keep_members(docs, "lang", known, keep=False)
