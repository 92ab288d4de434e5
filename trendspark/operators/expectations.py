"""Declarative expectations. Nulls are skipped except by the not-null check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.functions.times import DATE_PREFIX_CHECK, DURATION_CHECK
from trendspark.operators.quantiles import quantile_map
from trendspark.schema import REQUIRED_COLUMNS
from trendspark.session import c

# Bounds and allowed values of the standard suite.
CATEGORY_RANGE = (1, 44)
ROW_COUNT_RANGE = (100, 500_000)
ID_LENGTH = 11
VALUE_SETS = {"dimension": ["2d", "3d"], "definition": ["hd", "sd"], "projection": ["rectangular", "360"]}


@dataclass(frozen=True)
class Row:
    """A row-level expectation: the rows meeting ``violated`` are unexpected."""

    dimension: str
    check: str
    column: str
    violated: Column


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ColumnSet:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class RowCount:
    lo: int
    hi: int


@dataclass(frozen=True)
class Median:
    column: str
    lo: float


Expectation = Row | Unique | ColumnSet | RowCount | Median


def not_null(*cols: str) -> list[Row]:
    return [Row("Completeness", "not_null", n, c(n).isNull()) for n in cols]


def between(col: str, lo: float | None = None, hi: float | None = None) -> Row:
    bad: Column = F.lit(False)
    if lo is not None:
        bad = bad | (c(col) < lo)
    if hi is not None:
        bad = bad | (c(col) > hi)
    return Row("Accuracy", "between", col, bad)


def matches(col: str, pattern: str) -> Row:
    return Row("Accuracy", "matches_regex", col, ~c(col).cast("string").rlike(pattern))


def in_set(col: str, values: Sequence) -> Row:
    return Row("Consistency", "in_set", col, ~c(col).isin(list(values)))


def length_between(col: str, lo: int, hi: int) -> Row:
    size = F.length(c(col).cast("string"))
    return Row("Structure", "length_between", col, (size < lo) | (size > hi))


def unique(*cols: str) -> Unique:
    return Unique(tuple(cols))


def column_set(cols: Sequence[str]) -> ColumnSet:
    return ColumnSet(tuple(cols))


def row_count(lo: int, hi: int) -> RowCount:
    return RowCount(lo, hi)


def median_at_least(col: str, lo: float) -> Median:
    return Median(col, lo)


def _result(dimension: str, check: str, column: str, passed: Column, count: Column) -> list[Column]:
    return [
        F.lit(dimension).alias("dimension"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        passed.alias("passed"),
        count.cast("bigint").alias("unexpected_count"),
    ]


def _one_pass(df: DataFrame, rows: Sequence[Row], sizes: Sequence[RowCount]) -> DataFrame:
    """Row-level expectations and row counts from one aggregate."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(r.violated).alias(f"v{i}") for i, r in enumerate(rows)])
    cells = [
        F.struct(*_result(r.dimension, r.check, r.column, c(f"v{i}") == 0, c(f"v{i}"))) for i, r in enumerate(rows)
    ]
    for s in sizes:
        ok = (c("n") >= s.lo) & (c("n") <= s.hi)
        cells.append(F.struct(*_result("Distribution", "row_count", "table", ok, F.when(ok, 0).otherwise(1))))
    return wide.select(F.inline(F.array(*cells)))


def _samples(df: DataFrame, rows: Sequence[Row], size: int) -> DataFrame:
    """The ``size`` smallest unexpected values per row-level check, as text.

    The ranked filter keeps at most ``size`` rows per check in each task before the shuffle.
    """
    hits = F.array(
        *[
            F.when(r.violated, F.struct(F.lit(r.check).alias("check"), F.lit(r.column).alias("column"), c(r.column).cast("string").alias("v")))
            for r in rows
        ]
    )
    long = df.select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h")).select("h.*").filter("v is not null")
    first = Window.partitionBy("check", "column").orderBy("v")
    top = long.withColumn("_n", F.row_number().over(first)).filter(c("_n") <= size)
    return top.groupBy("check", "column").agg(F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("sample"))


def run_suite(df: DataFrame, suite: Sequence[Expectation], samples: int = 3) -> DataFrame:
    """(dimension, check, column, passed, unexpected_count, sample), one row per expectation."""
    rows = [e for e in suite if isinstance(e, Row)]
    sizes = [e for e in suite if isinstance(e, RowCount)]
    parts: list[DataFrame] = []
    if rows or sizes:
        parts.append(_one_pass(df, rows, sizes))
    for e in suite:
        if isinstance(e, Unique):
            label = e.columns[0] if len(e.columns) == 1 else "compound"
            known = df
            for name in e.columns if len(e.columns) == 1 else ():
                known = known.filter(c(name).isNotNull())
            repeated = known.groupBy(*[c(n) for n in e.columns]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            count = F.coalesce(F.sum("n"), F.lit(0))
            parts.append(repeated.agg(count.alias("k")).select(*_result("Uniqueness", "unique", label, c("k") == 0, c("k"))))
        elif isinstance(e, ColumnSet):
            wrong = len(set(e.columns) ^ set(df.columns))
            one = df.sparkSession.range(1)
            parts.append(one.select(*_result("Consistency", "column_set", "table", F.lit(wrong == 0), F.lit(wrong))))
    medians = [e for e in suite if isinstance(e, Median)]
    if medians:
        # All medians come from the same two scans.
        found = quantile_map(df, list(dict.fromkeys(e.column for e in medians)), [0.5])
        one = df.sparkSession.range(1)
        for e in medians:
            level = found[e.column, 0.5]
            ok = F.lit(level is not None and level >= e.lo)
            parts.append(one.select(*_result("Distribution", "median", e.column, ok, F.when(ok, 0).otherwise(1))))
    checks = reduce(DataFrame.unionByName, parts)
    if not samples or not rows:
        return checks.withColumn("sample", F.lit(None).cast("string"))
    # One row per check on both sides.
    return checks.join(F.broadcast(_samples(df, rows, samples)), ["check", "column"], "left").select(
        "dimension", "check", "column", "passed", "unexpected_count", "sample"
    )


def suite_passed(checks: DataFrame) -> DataFrame:
    return checks.agg(F.every("passed").alias("passed"), F.count(F.lit(1)).alias("checks"))


def video_suite(columns: Sequence[str], table_columns: Sequence[str], counts: Sequence[str]) -> list[Expectation]:
    """The standard suite; raw and cleaned tables differ only in their column lists."""
    suite: list[Expectation] = [*not_null(*REQUIRED_COLUMNS)]
    suite += [between(n, 0) for n in counts]
    suite.append(between("categoryId", *CATEGORY_RANGE))
    suite.append(matches("duration", DURATION_CHECK))
    suite.append(matches("publishedAt", DATE_PREFIX_CHECK))
    suite.append(unique(*table_columns))
    suite.append(unique("video_id"))
    suite.append(column_set(columns))
    suite += [in_set(n, values) for n, values in VALUE_SETS.items()]
    suite.append(row_count(*ROW_COUNT_RANGE))
    suite.append(median_at_least("view_count", 1))
    suite.append(length_between("video_id", ID_LENGTH, ID_LENGTH))
    return suite
