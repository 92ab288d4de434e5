"""One-pass evaluation of many table checks.

A probe is a few aggregate expressions plus a verdict over them. However many
probes are evaluated, the table is scanned once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.session import c

CHECK_SCHEMA = "dimension string, check string, column string, passed boolean, issue_count bigint, detail string"


@dataclass(frozen=True)
class Probe:
    dimension: str
    check: str
    column: str
    aggs: Sequence[Column]
    # (aggregate results) -> (passed, issue count, detail)
    verdict: Callable[[Sequence[Column]], tuple[Column, Column, Column]]


def fixed_rows(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Check rows known without looking at data."""
    return df.sparkSession.createDataFrame(list(rows), CHECK_SCHEMA)


def evaluate(df: DataFrame, probes: Sequence[Probe]) -> DataFrame:
    if not probes:
        return fixed_rows(df, [])
    aggs = [expr.alias(f"p{i}_{j}") for i, p in enumerate(probes) for j, expr in enumerate(p.aggs)]
    rows = []
    for i, probe in enumerate(probes):
        passed, count, detail = probe.verdict([c(f"p{i}_{j}") for j in range(len(probe.aggs))])
        rows.append(
            F.struct(
                F.lit(probe.dimension).alias("dimension"),
                F.lit(probe.check).alias("check"),
                F.lit(probe.column).alias("column"),
                passed.alias("passed"),
                count.cast("bigint").alias("issue_count"),
                detail.cast("string").alias("detail"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def no_detail() -> Column:
    return F.lit(None).cast("string")


def zero_count(dimension: str, check: str, column: str, violated: Column, fails: bool = True) -> Probe:
    """Passes when no row meets ``violated``."""

    def verdict(r: Sequence[Column]) -> tuple[Column, Column, Column]:
        return (r[0] == 0 if fails else F.lit(True)), r[0], no_detail()

    return Probe(dimension, check, column, [F.count_if(violated)], verdict)
