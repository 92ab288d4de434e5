"""Equi-joins. No broadcast is forced: sides are sized by the planner or by AQE at run time,
which also splits skewed keys of the larger side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.session import c


def enrich_left(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    return base.join(extra, key, "left")


def merge_scraped(base: DataFrame, scraped: DataFrame, key: str, conflicts: Sequence[str]) -> DataFrame:
    """Left join; a column held by both sides takes the right value, else the left one."""
    right = scraped.withColumnsRenamed({n: f"{n}_y" for n in conflicts})
    joined = base.join(right, key, "left")
    merged = {n: F.coalesce(c(f"{n}_y"), c(n)) for n in conflicts}
    return joined.withColumns(merged).drop(*[f"{n}_y" for n in conflicts])


def map_lookup(df: DataFrame, col: str, table: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Replace ``col`` by ``table[value]``; unseen values become null. ``table`` is unique on ``col``."""
    pairs = table.select(c(col).alias("__key"), c(value).alias("__mapped"))
    target = out or col
    joined = df.join(pairs, c(col) == c("__key"), "left")
    kept = [c("__mapped").alias(target) if n == target else c(n) for n in df.columns]
    if target not in df.columns:
        kept.append(c("__mapped").alias(target))
    return joined.select(*kept)


def exclude_known(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return candidates.join(known.select(key), key, "left_anti")


def keep_members(df: DataFrame, col: str, members: DataFrame, keep: bool = True) -> DataFrame:
    """Rows whose value is (or with ``keep=False`` is not) in the one-column set."""
    return df.join(members.select(c(members.columns[0]).alias(col)), col, "left_semi" if keep else "left_anti")
