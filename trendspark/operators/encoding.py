"""Category grouping and frequency encoding.

Values of all columns are counted in one scan and written to shared storage. Frequent values are looked up in a small map,
the others by a join (see ``heavy``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.text import normalize_language
from trendspark.operators.heavy import heavy_condition, split_lookup
from trendspark.session import c, durable


def _as_key(df: DataFrame, name: str) -> Column:
    """A column's value as text, so that columns of several types share one table; both zeros are one value."""
    kind = df.schema[name].dataType
    value = c(name) + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else c(name)
    return value.cast("string")


def _free(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stored (column, value, n, total) of the non-null values of all columns, as text, from one scan."""
    cells = F.array(*[F.struct(F.lit(i).alias("column"), _as_key(df, n).alias("value")) for i, n in enumerate(cols)])
    long = df.select(F.inline(cells)).filter("value IS NOT NULL")
    counts = durable(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    totals = {r["column"]: r["total"] for r in counts.groupBy("column").agg(F.sum("n").alias("total")).collect()}  # one row per column
    total = F.element_at(F.array(*[F.lit(totals.get(i, 0)).cast("bigint") for i in range(len(cols))]), c("column") + 1)
    return counts.withColumn("total", total)


def _group_rare(df: DataFrame, col: str, rare: Column, other: object, out: str | None) -> DataFrame:
    """``other`` where a value is rare by its (n, total)."""
    counts = value_counts(df, [col])
    often = heavy_condition("n", c("total"))
    mark = _free(df, "_rare")
    marked = counts.withColumn(mark, rare)
    heavy, light = marked.filter(often), marked.filter(~often & c(mark))
    found = split_lookup(df, _as_key(df, col), heavy, light, "value", [mark])
    target = out or col
    replaced = F.when(c(mark), F.lit(other).cast(df.schema[col].dataType)).otherwise(c(col)).alias(target)
    kept = [replaced if n == target else c(n) for n in df.columns]
    return found.select(*kept, *([] if target in df.columns else [replaced]))


def group_rare_share(df: DataFrame, col: str, threshold: float, other: object = "other", out: str | None = None) -> DataFrame:
    """``other`` for values whose share of the non-null rows is below ``threshold``."""
    return _group_rare(df, col, c("n") / c("total") < F.lit(threshold), other, out)


def group_rare_count(df: DataFrame, col: str, min_count: int = 500, other: object = 29, out: str | None = None) -> DataFrame:
    return _group_rare(df, col, c("n") < min_count, other, out)


@dataclass(frozen=True)
class FrequencyEncoding:
    """Share of each value in the fitted table, for all columns from one scan and in one stored table."""

    cols: Sequence[str]
    counts: DataFrame
    missing: float | None = None

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str], missing: float | None = None) -> FrequencyEncoding:
        return cls(tuple(cols), value_counts(train, cols), missing)

    def apply(self, df: DataFrame) -> DataFrame:
        name_ = _free(df, "_share")
        shares = self.counts.withColumn(name_, c("n") / c("total"))
        out = df
        for i, name in enumerate(self.cols):
            mine = shares.filter(c("column") == i)
            often = heavy_condition("n", c("total"))
            found = split_lookup(out, _as_key(df, name), mine.filter(often), mine.filter(~often), "value", [name_])
            share = c(name_) if self.missing is None else F.coalesce(c(name_), F.lit(self.missing))
            out = found.select(*[share.alias(n) if n == name else c(n) for n in df.columns])
        return out


def clean_language(df: DataFrame, col: str, codes: DataFrame, unknown: str = "unknown") -> DataFrame:
    """Values whose base code is not in the one-column ``codes`` become ``unknown``; null stays."""
    known = durable(codes.select(c(codes.columns[0]).alias("__code")).distinct(), "codes")
    joined = df.withColumn("__base", normalize_language(c(col))).join(known, c("__base") == c("__code"), "left")
    fixed = F.when(c(col).isNotNull() & c("__code").isNull(), F.lit(unknown)).otherwise(c(col))
    return joined.withColumn(col, fixed).select(*[c(n) for n in df.columns])
