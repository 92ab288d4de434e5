"""From separate sources to one raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.operators.dedupe import dedupe_key, known_ids, union_sources
from trendspark.operators.joins import enrich_left, exclude_known, merge_scraped
from trendspark.operators.projection import add_metadata, align_columns, rename_columns
from trendspark.schema import API_RENAMES
from trendspark.sources.flatten import flatten_items


def items_table(items: DataFrame, renames: Mapping[str, str] = API_RENAMES) -> DataFrame:
    """Nested items to a flat table with the standard names."""
    return rename_columns(flatten_items(items), renames)


def labelled_source(items: DataFrame, is_trending: bool, today: str, base: DataFrame) -> DataFrame:
    """Items of one label, shaped like ``base``."""
    labelled = add_metadata(items_table(items), is_trending, today)
    kind = base.schema["is_trending"].dataType if "is_trending" in base.columns else None
    if kind is not None:
        labelled = labelled.withColumn("is_trending", labelled["is_trending"].cast(kind))
    return align_columns(labelled, base.schema)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the same on any partitioning: the first by the JSON text of the whole row."""
    return dedupe_key(df.withColumn("_whole", F.to_json(F.struct("*"))), key, ["_whole"]).drop("_whole")


def acquire(
    base: DataFrame, details: DataFrame, trending: DataFrame, candidates: DataFrame, scraped: DataFrame, today: str, key: str = "video_id"
) -> DataFrame:
    """Enrich the base table, add both labelled sources, then join page features.

    Candidates already known, and repeats among them, are left out. Page features win over table values of the same name.
    """
    details_table = items_table(details)
    big = enrich_left(base, one_per_key(details_table, key), key)
    hot = labelled_source(trending, True, today, big)
    fresh = labelled_source(candidates, False, today, big)
    fresh = exclude_known(one_per_key(fresh, key), known_ids([big, hot], key), key)
    together = union_sources([big, hot, fresh])
    shared = [n for n in scraped.columns if n != key and n in together.columns]
    return merge_scraped(together, scraped, key, shared)
