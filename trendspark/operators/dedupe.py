"""Set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.session import c


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by name; all frames must have the same column set."""
    wanted = set(frames[0].columns)
    for frame in frames[1:]:
        if set(frame.columns) != wanted:
            raise ValueError(f"column sets differ: {sorted(wanted ^ set(frame.columns))}")
    return reduce(DataFrame.unionByName, frames)


def known_ids(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct non-null ids over all frames."""
    ids = [f.select(key).filter(c(key).isNotNull()) for f in frames]
    return reduce(DataFrame.union, ids).distinct()


def schema_diff(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Missing and extra columns as rows (a schema is bounded metadata, not data)."""
    have = set(df.columns)
    rows = [("missing", n) for n in expected if n not in have]
    rows += [("extra", n) for n in df.columns if n not in set(expected)]
    return df.sparkSession.createDataFrame(rows, "kind string, column string")


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order``.

    The planner turns "row number = 1" into a group limit that runs before the
    shuffle, so a key holding a third of the table sends one row per task. The
    result does not depend on partitioning.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = Window.partitionBy(*[c(k) for k in keys]).orderBy(*[c(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("__nth", F.row_number().over(first)).filter(c("__nth") == 1).drop("__nth")


def duplicate_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows that share all of ``cols`` with another row: groups, rows in them, rows beyond the first."""
    names = list(cols) if cols is not None else df.columns
    sizes = df.groupBy(*[c(n) for n in names]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("extra_rows"),
    )
