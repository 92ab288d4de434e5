"""Cleaning pipeline, audit log and incremental collection queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.catalog.base import VIDEOS_SQL, query, rounded, table, videos
from trendspark.plans.acquire import acquire as acquire_plan
from trendspark.plans.cleaning import CleaningPipeline, DecisionLog, build_default_pipeline
from trendspark.session import c, durable, scratch_path
from trendspark.sources.flatten import flatten_items as flatten
from trendspark.sources.writers import append_progress
from trendspark.streaming.ingest import incremental_ingest as ingest
from trendspark.streaming.ingest import resume_pending as pending

# Raw records: every video once, those of category 1 again with other figures.
_RAW_SQL = f"""{VIDEOS_SQL},
copies AS (SELECT *, 0 AS _row FROM videos UNION ALL SELECT * REPLACE (likes + 1 AS likes), 1 FROM videos WHERE "categoryId" = 1),
raw AS (SELECT _row, video_id, 'Video ' || "channelId" AS title,
  CASE "categoryId" WHEN 1 THEN NULL WHEN 2 THEN '[''a'', ''b'']' ELSE 'x, y,' END AS tags,
  CASE WHEN "channelId" % 3 <> 0 THEN 'about' END AS description, view_count, likes,
  CASE WHEN comments_disabled AND comment_count > 3 THEN NULL WHEN comments_disabled AND comment_count = 1 THEN 0 ELSE comment_count END AS comment_count,
  comments_disabled, CASE "channelId" % 4 WHEN 0 THEN 'en-US' WHEN 1 THEN 'zz' WHEN 3 THEN 'FR' END AS lang,
  likes // 1000 AS chapter_count, is_trending FROM copies)"""


def raw_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = durable(videos(spark, sf_dir), "videos")
    again = vids.filter("categoryId = 1").withColumn("likes", c("likes") + 1).withColumn("_row", F.lit(1))
    copies = vids.withColumn("_row", F.lit(0)).unionByName(again)
    off, n, channel = c("comments_disabled"), c("comment_count"), c("channelId")
    return copies.select(
        "_row",
        "video_id",
        F.concat(F.lit("Video "), channel.cast("string")).alias("title"),
        F.when(c("categoryId") == 2, "['a', 'b']").when(c("categoryId") != 1, "x, y,").alias("tags"),
        F.when(channel % 3 != 0, "about").alias("description"),
        c("view_count").cast("string").alias("view_count"),
        c("likes").cast("string").alias("likes"),
        F.when(off & (n > 3), F.lit(None)).when(off & (n == 1), 0).otherwise(n).alias("comment_count"),
        F.when(off, "True").otherwise("False").alias("comments_disabled"),
        F.when(channel % 4 == 0, "en-US").when(channel % 4 == 1, "zz").when(channel % 4 == 3, "FR").alias("defaultLanguage"),
        F.floor(c("likes") / 1000).cast("bigint").alias("chapter_count"),
        c("is_trending").cast("string").alias("is_trending"),
        F.lit("https://example.com/t.jpg").alias("thumbnail_link"),
    )


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(c("lang").alias("code")).distinct()


_STEPS_SQL = f"""{_RAW_SQL},
one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY _row) AS rn FROM raw) WHERE rn = 1),
ok AS (SELECT * FROM one WHERE coalesce(likes, 0) <= coalesce(view_count, 0)
  AND (comment_count IS NULL OR (comment_count >= 0 AND NOT comments_disabled) OR (comment_count = 0 AND comments_disabled))),
filled AS (SELECT * REPLACE (CASE WHEN comment_count IS NULL AND comments_disabled THEN 0 ELSE comment_count END AS comment_count) FROM ok),
whole AS (SELECT * FROM filled WHERE lang IS NOT NULL AND comment_count IS NOT NULL),
logs AS (SELECT *, ln(view_count + 1.0) AS lv, ln(likes + 1.0) AS ll, ln(comment_count + 1.0) AS lc FROM whole),
b AS (SELECT avg(lv) AS mv, 3 * stddev_samp(lv) AS sv, avg(ll) AS ml, 3 * stddev_samp(ll) AS sl, avg(lc) AS mc, 3 * stddev_samp(lc) AS sc FROM logs)"""


@query(
    f"""WITH {_STEPS_SQL}
SELECT video_id, CASE WHEN tags IS NULL THEN '' WHEN tags LIKE '[%' THEN '''a''|''b''' ELSE 'x|y' END AS tags, coalesce(description, '') AS description,
  comments_disabled, CASE WHEN lower(string_split(lang, '-')[1]) IN (SELECT DISTINCT lang FROM documents) THEN lang ELSE 'unknown' END AS "defaultLanguage",
  round(least(greatest(lv, mv - sv), mv + sv), 4) AS view_count, round(least(greatest(ll, ml - sl), ml + sl), 4) AS likes,
  round(least(greatest(lc, mc - sc), mc + sc), 4) AS comment_count, least(chapter_count, 20) AS chapter_count, cast(is_trending AS bigint) AS is_trending
FROM logs, b"""
)
def clean_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard eleven steps on raw records."""
    out = build_default_pipeline(_codes(spark, sf_dir)).fit_transform(raw_videos(spark, sf_dir))
    out = out.withColumn("tags", F.array_join("tags", "|")).drop("_row", "title")
    return rounded(out, "view_count", "likes", "comment_count")


@query(
    f"""WITH {_STEPS_SQL}, n AS (SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM one) AS one, (SELECT count(*) FROM ok) AS ok, (SELECT count(*) FROM whole) AS whole)
SELECT 1 AS position, 'Accuracy' AS step, raw - one AS records_affected FROM n
UNION ALL SELECT 2, 'Consistency', one - ok FROM n
UNION ALL SELECT 3, 'Relevance', 0
UNION ALL SELECT 4, 'Consistency', ok FROM n
UNION ALL SELECT 5, 'Completeness', count(*) FILTER (description IS NULL) FROM ok
UNION ALL SELECT 6, 'Completeness', count(*) FILTER (comment_count IS NULL AND comments_disabled) FROM ok
UNION ALL SELECT 7, 'Completeness', ok - whole FROM n
UNION ALL SELECT 8, 'Type Casting', 0
UNION ALL SELECT 9, 'Consistency', count(*) FILTER (lower(string_split(lang, '-')[1]) NOT IN (SELECT DISTINCT lang FROM documents)) FROM whole
UNION ALL SELECT 10, 'Transformation', whole FROM n
UNION ALL SELECT 11, 'Outliers', count(*) FILTER (lv < mv - sv OR lv > mv + sv) + count(*) FILTER (ll < ml - sl OR ll > ml + sl)
  + count(*) FILTER (lc < mc - sc OR lc > mc + sc) + count(*) FILTER (chapter_count < 0 OR chapter_count > 20) FROM logs, b"""
)
def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each cleaning step affected."""
    pipeline = build_default_pipeline(_codes(spark, sf_dir))
    pipeline.fit_transform(raw_videos(spark, sf_dir))
    return pipeline.log.to_df(spark).select("position", "step", "records_affected")


@query("SELECT o_orderstatus, count(*) AS n, round(avg(ln(o_totalprice + 1)), 4) AS mean_log FROM orders WHERE o_totalprice > 100000 AND o_orderpriority <> '5-LOW' GROUP BY 1")
def custom_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own table functions as steps, run as one lazy plan."""

    def above(df: DataFrame, log: DecisionLog | None = None, col: str = "", limit: float = 0.0) -> DataFrame:
        return df.filter(c(col) > limit)

    def logged(df: DataFrame, log: DecisionLog | None = None, col: str = "") -> DataFrame:
        return df.withColumn(col, F.log1p(c(col)))

    pipeline = (
        CleaningPipeline()
        .add_step("Price floor", above, col="o_totalprice", limit=100000.0)
        .add_step("Priority", lambda df, log=None: df.filter(c("o_orderpriority") != "5-LOW"))
        .add_step("Log", logged, col="o_totalprice")
    )
    out = pipeline.transform(table(spark, sf_dir, "orders"))
    return rounded(out.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_log")), "mean_log")


# --- acquisition ----------------------------------------------------------------------


def _items(df: DataFrame) -> DataFrame:
    """Part rows in the nested shape of API items."""
    thumbs = F.struct(
        F.struct(F.concat(F.lit("http://img/"), c("id"), F.lit(".png")).alias("url")).alias("default"),
        F.struct(F.lit("http://big").alias("url")).alias("high"),
    )
    return df.select(
        "id",
        F.struct(c("title"), thumbs.alias("thumbnails")).alias("snippet"),
        F.struct(c("views").cast("string").alias("viewCount")).alias("statistics"),
        F.struct(F.struct(c("blocked")).alias("regionRestriction")).alias("contentDetails"),
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", c("p_partkey").cast("string").alias("id"), c("p_name").alias("title"), c("p_size").alias("views"), F.when(c("p_size") > 45, c("p_brand")).alias("blocked")
    )


@query(
    """SELECT p_partkey::varchar AS id, 'http://img/' || p_partkey || '.png' AS thumbnail_link, p_name AS title, p_size::varchar AS "viewCount",
  CASE WHEN p_size > 45 THEN p_brand END AS "contentDetails.regionRestriction.blocked" FROM part"""
)
def flatten_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested items to flat columns: two-level names become the leaf, deeper ones stay dotted."""
    return flatten(_items(_parts(spark, sf_dir)))


@query(
    """WITH base AS (SELECT p_partkey, p_partkey::varchar AS video_id, p_retailprice AS price, p_size, p_name FROM part),
big AS (SELECT p_partkey, video_id, price, 0 AS is_trending, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title, 'base' AS kind, p_size FROM base WHERE p_partkey % 4 <> 3),
hot AS (SELECT p_partkey, video_id, CAST(NULL AS DOUBLE) AS price, 1 AS is_trending, p_name AS title, 'hot' AS kind, p_size FROM base WHERE p_partkey % 4 = 3 AND p_size < 25),
fresh AS (SELECT p_partkey, video_id, CAST(NULL AS DOUBLE), 0, p_name, 'fresh', p_size FROM base WHERE p_size % 2 = 0 AND p_partkey % 4 = 3 AND p_size >= 25),
u AS (SELECT * FROM big UNION ALL SELECT * FROM hot UNION ALL SELECT * FROM fresh)
SELECT video_id, price, is_trending, title, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS card_count,
  coalesce(CASE WHEN p_partkey % 5 IN (1, 2) THEN p_partkey % 5 = 1 END, CASE WHEN kind = 'base' THEN p_size > 20 END) AS comments_disabled FROM u"""
)
def acquire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base enriched by details, trending and new candidates added, page features joined."""
    parts = _parts(spark, sf_dir)
    prices = table(spark, sf_dir, "part").select(c("p_partkey").alias("k"), c("p_retailprice").alias("price"))
    base = parts.join(prices, c("p_partkey") == c("k")).filter("p_partkey % 4 <> 3").select(
        c("id").alias("video_id"), "price", F.lit(0).alias("is_trending"), (c("views") > 20).alias("comments_disabled")
    )
    details = _items(parts.filter("p_partkey % 2 = 0"))
    trending = _items(parts.filter("p_partkey % 4 = 3 and views < 25"))
    candidates = _items(parts.filter("views % 2 = 0"))
    flag = F.when(c("p_partkey") % 5 < 3, c("p_partkey") % 5 == 1)
    scraped = parts.filter("p_partkey % 5 <> 0").select(c("id").alias("video_id"), c("views").alias("card_count"), flag.alias("comments_disabled"))
    out = acquire_plan(base, details, trending, candidates, scraped, "2026-04-10")
    return out.select("video_id", "price", "is_trending", "title", "card_count", "comments_disabled")


# --- incremental collection --------------------------------------------------------------


@query("SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an event yet."""
    ids = table(spark, sf_dir, "orders").select(c("o_custkey").alias("user_id")).distinct()
    return pending(ids, table(spark, sf_dir, "events").select("user_id"), "user_id")


@query(
    """SELECT user_id, arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY 1"""
)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event per user, collected over two runs of a restartable stream."""
    schema = T.StructType.fromDDL("user_id bigint, event_id bigint, event_type string")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    cut = events.agg(F.avg("event_id")).first()[0]
    home = scratch_path(spark, "ingest")
    append_progress(events.filter(c("event_id") <= cut), f"{home}/in")
    ingest(spark, f"{home}/in", f"{home}/sink", f"{home}/state", schema, "user_id", ["event_id"])
    append_progress(events.filter(c("event_id") > cut), f"{home}/in")
    return ingest(spark, f"{home}/in", f"{home}/sink", f"{home}/state", schema, "user_id", ["event_id"])
