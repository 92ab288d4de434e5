"""Readers. File order is kept as an explicit column where a later step needs it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.text import normalize_language
from trendspark.operators.dedupe import dedupe_key
from trendspark.schema import EXTRA_LANGUAGES
from trendspark.session import c

ORDER_COLUMN = "_row"


def read_videos_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, order: bool = True
) -> DataFrame:
    """CSV with header and quoted text. ``multi_line=False`` lets Spark split files without embedded line breaks."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df.withColumn(ORDER_COLUMN, _place()) if order else df


def _place() -> Column:
    """Where a row stood: files by path, then the part of the file, then the order of reading."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_csv_keep_empty(
    spark: SparkSession, path: str, schema: T.StructType, text_cols: Sequence[str], multi_line: bool = True
) -> DataFrame:
    """As above, but blank text cells are '' instead of null."""
    df = read_videos_csv(spark, path, schema, multi_line, order=False)
    return df.withColumns({n: F.coalesce(c(n), F.lit("")) for n in text_cols})


def read_items_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A JSON array of records per file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """File and folder names directly under ``path``; empty if it is absent."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def cached(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Read the backup at ``path``; if it is absent or unfinished, compute and write it first.

    The backup is Parquet, so types and columns come back as they were, also of an empty table.
    """
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_progress(
    spark: SparkSession, path: str, key: str, schema: T.StructType, order: str | None = None
) -> DataFrame:
    """JSON lines; malformed lines are skipped and the last record per key wins.

    ``order`` names the recency column. Without one, later lines of later files win.
    """
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    rows = rows.filter(c(key).isNotNull())
    if order is not None:
        return last_per_key(rows, key, [c(order)])
    seen = rows.withColumns({"_time": F.col("_metadata.file_modification_time"), "_place": _place()})
    return last_per_key(seen, key, [c("_time"), c("_place")]).drop("_time", "_place")


def last_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key; limited per key before the shuffle."""
    return dedupe_key(df, key, [o.desc() for o in order])


def language_codes(items: DataFrame, extra: Sequence[str] = tuple(EXTRA_LANGUAGES)) -> DataFrame:
    """One column ``code``: lower-case base codes of a language list (items[].snippet.hl), plus ``extra``."""
    listed = items.select(F.explode("items").alias("item")).select(normalize_language(F.col("item.snippet.hl")).alias("code"))
    more = items.sparkSession.createDataFrame([(e,) for e in extra], "code string")
    return listed.filter("code is not null").union(more).distinct()


def load_language_codes(spark: SparkSession, path: str, extra: Sequence[str] = tuple(EXTRA_LANGUAGES)) -> DataFrame:
    schema = T._parse_datatype_string("items array<struct<snippet:struct<hl:string>>>")
    return language_codes(read_items_json(spark, path, schema), extra)


def keep_first(df: DataFrame, key: str) -> DataFrame:
    """First row per key in file order, for tables read with an order column."""
    return dedupe_key(df, key, [ORDER_COLUMN])
