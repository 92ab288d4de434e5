"""Reader and writer queries: data makes a round trip through storage and is compared with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.catalog.base import query, table
from trendspark.catalog.cleaning import _STEPS_SQL, raw_videos
from trendspark.operators.checks import check_blank, check_variance
from trendspark.plans.cleaning import CleaningPipeline, filter_invalid_rows, fix_comment_count, remove_duplicates
from trendspark.session import c, scratch_path
from trendspark.sources import readers, writers


@query("SELECT doc_id, lang, length(text) AS n, md5(text) AS digest FROM documents")
def read_videos_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes and line breaks through CSV."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "csv")
    writers.write_table(docs, path, "csv")
    back = readers.read_videos_csv(spark, path, docs.schema)
    return back.select("doc_id", "lang", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("digest"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE source END AS source, CASE WHEN lang = 'fr' THEN NULL ELSE n_chars END AS n_chars FROM documents")
def read_csv_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank text cells read as empty text, blank numbers as null."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(c("lang") == "en", "").otherwise(c("source")).alias("source"), F.when(c("lang") != "fr", c("n_chars")).alias("n_chars")
    )
    path = scratch_path(spark, "csv")
    writers.write_table(docs, path, "csv")
    return readers.read_csv_keep_empty(spark, path, docs.schema, ["source"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, cast(sum(l_quantity) AS bigint) AS quantity FROM lineitem GROUP BY 1, 2")
def write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned parquet copy, read back and aggregated."""
    path = scratch_path(spark, "lines")
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    writers.write_table(lines, path, partition_by=["l_returnflag"])
    back = spark.read.parquet(path)
    return back.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def cached_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Computed on the first call, read from the backup on the second."""
    path = scratch_path(spark, "backup")
    rows = table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))

    def unavailable() -> DataFrame:
        raise AssertionError("the backup must be used")

    readers.cached(spark, path, lambda: rows)
    return readers.cached(spark, path, unavailable)


@query("SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(md5(text), turn) AS digest FROM conversations GROUP BY 1")
def read_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with malformed ones among them; the last turn per conversation wins."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.md5("text").alias("digest"))
    path = scratch_path(spark, "progress")
    writers.append_progress(turns, path)
    turns.select(F.concat(F.lit('{"conv_id": '), c("conv_id").cast("string"), F.lit(', "turn":')).alias("value")).write.mode("append").text(path)
    return readers.read_progress(spark, path, "conv_id", turns.schema, "turn")


@query("SELECT role, count(*) AS n, sum(turn)::bigint AS turns FROM conversations GROUP BY 1")
def append_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends leave every line."""
    turns = table(spark, sf_dir, "conversations").select("role", "turn")
    path = scratch_path(spark, "progress")
    writers.append_progress(turns.filter("role = 'user'"), path)
    writers.append_progress(turns.filter("role <> 'user'"), path)
    return spark.read.schema(turns.schema).json(path).groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sum("turn").alias("turns"))


@query("SELECT DISTINCT lower(lang) AS code FROM documents UNION SELECT 'und' UNION SELECT 'zxx'")
def language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base codes of a language list, written in its nested JSON shape, plus extra ones."""
    code = F.concat(F.upper(c("lang")), F.lit("-"), F.upper(F.substring("source", 1, 2)))
    item = F.struct(F.struct(code.alias("hl")).alias("snippet"))
    # One list record per source and language: the list stays a list, however many documents there are.
    rows = table(spark, sf_dir, "documents").select("lang", "source").distinct().select(F.array(item).alias("items"))
    path = scratch_path(spark, "codes")
    rows.write.json(path)
    schema = T.StructType.fromDDL("items array<struct<snippet:struct<hl:string>>>")
    return readers.language_codes(spark.read.schema(schema).json(path), ["und", "zxx"])


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer")
def read_items_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that each hold one JSON array of records."""
    rows = table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_nationkey").alias("nation"))
    # Arrays of a bounded number of records, whatever the table's size.
    groups = rows.groupBy(F.floor(c("id") / 500).alias("g")).agg(F.to_json(F.collect_list(F.struct("id", "name", "nation"))).alias("value"))
    path = scratch_path(spark, "items")
    groups.write.partitionBy("g").text(path)
    return readers.read_items_json(spark, path, rows.schema).select("id", "name", "nation")


@query(
    """SELECT dimension, passed, sum(n)::bigint AS rows FROM (
  SELECT 'Completeness' AS dimension, count(*) FILTER (regexp_matches(p_name, '^\\s*$')) = 0 AS passed, 2 AS n FROM part
  UNION ALL SELECT 'Distribution', stddev_samp(p_size) <> 0, 2 FROM part) GROUP BY 1, 2"""
)
def write_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results appended by two runs."""
    part, path = table(spark, sf_dir, "part"), scratch_path(spark, "checks")
    for _ in range(2):
        writers.write_checks(check_blank(part, ["p_name"]).unionByName(check_variance(part, ["p_size"])), path)
    return spark.read.parquet(path).groupBy("dimension", "passed").agg(F.count(F.lit(1)).alias("rows"))


@query(
    f"""WITH {_STEPS_SQL}, n AS (SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM one) AS one, (SELECT count(*) FROM ok) AS ok)
SELECT 1 AS position, 'Accuracy' AS step, raw - one AS records_affected FROM n UNION ALL SELECT 2, 'Consistency', one - ok FROM n
UNION ALL SELECT 3, 'Completeness', count(*) FILTER (comment_count IS NULL AND comments_disabled) FROM ok"""
)
def write_decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a short pipeline, stored and read back."""
    pipeline = (
        CleaningPipeline()
        .add_step("Remove Duplicates", remove_duplicates)
        .add_step("Filter Invalid Rows", filter_invalid_rows)
        .add_step("Fix Comment Count", fix_comment_count)
    )
    pipeline.fit_transform(raw_videos(spark, sf_dir))
    path = scratch_path(spark, "log")
    writers.write_decision_log(pipeline.log.to_df(spark), path)
    return spark.read.parquet(path).select("position", "step", "records_affected")
