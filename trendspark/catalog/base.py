"""Query registry and the derived tables shared by queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        assert fn.__name__ not in REGISTRY, fn.__name__
        REGISTRY[fn.__name__] = Entry(fn, sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    """Round the listed columns; a rounded zero carries no sign."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) + F.lit(0.0) for n in cols})


# The video table: one row per order, with figures from its lines.
VIDEOS_SQL = """
lines AS (
  SELECT l_orderkey, sum(l_quantity) AS quantity, count(l_linenumber) AS n_lines
  FROM lineitem GROUP BY l_orderkey
),
videos AS (
  SELECT lpad(cast(o_orderkey AS varchar), 11, '0') AS video_id,
         o_custkey AS "channelId",
         cast(substr(o_orderpriority, 1, 1) AS int) AS "categoryId",
         o_orderdate AS "publishedAt",
         cast(floor(o_totalprice) AS bigint) AS view_count,
         cast(coalesce(quantity, 0) * 500 AS bigint) AS likes,
         n_lines AS comment_count,
         o_orderpriority = '5-LOW' AS comments_disabled,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_trending,
         o_custkey % 7 = 0 AS is_verified
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
)"""


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("quantity"), F.count("l_linenumber").alias("n_lines"))
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("video_id"),
        F.col("o_custkey").alias("channelId"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("categoryId"),
        F.col("o_orderdate").alias("publishedAt"),
        F.floor("o_totalprice").cast("bigint").alias("view_count"),
        (F.coalesce("quantity", F.lit(0.0)) * 500).cast("bigint").alias("likes"),
        F.col("n_lines").alias("comment_count"),
        (F.col("o_orderpriority") == "5-LOW").alias("comments_disabled"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_trending"),
        (F.col("o_custkey") % 7 == 0).alias("is_verified"),
    )


# Documents with their labels: real nulls on both label columns.
LABELLED_SQL = """
labelled AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
