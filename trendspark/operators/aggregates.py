"""Profiling and dashboard aggregates.

Totals beside group counts come from scalar subqueries: the groups themselves
are never gathered on one task, however many there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.numbers import known_number
from trendspark.operators.projection import is_numeric, names_by_rule
from trendspark.operators.quantiles import quantiles
from trendspark.session import c


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c(name).isNull() | F.isnan(c(name))
    return c(name).isNull()


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose group keys are all present: an unknown group is no group."""
    for key in keys:
        df = df.filter(c(key).isNotNull())
    return df


def value_shares(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """(value, n, share) per value; nulls are outside the denominator unless kept."""
    rows = df.select(c(col).alias("value"))
    if not keep_null:
        rows = rows.filter("value is not null")
    total = rows.agg(F.count(F.lit(1))).scalar()
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("share", c("n") / total)


def null_counts(df: DataFrame, top: int | None = None) -> DataFrame:
    """(column, nulls) of columns with any null, most first; one pass over the table."""
    names = df.columns
    counts = df.agg(*[F.count_if(missing(df, n)).alias(f"m{i}") for i, n in enumerate(names)])
    rows = [F.struct(F.lit(n).alias("column"), c(f"m{i}").alias("nulls")) for i, n in enumerate(names)]
    out = counts.select(F.inline(F.array(*rows))).filter("nulls > 0")
    return out if top is None else out.orderBy(F.desc("nulls"), "column").limit(top)


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n, mean, std, min, q25, median, q75, max) per numeric column."""
    names = list(cols) if cols is not None else names_by_rule(df, is_numeric)
    aggs = []
    for i, name in enumerate(names):
        x = known_number(name)
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    parts = ["n", "mean", "std", "min", "max"]
    rows = [
        F.struct(F.lit(n).alias("column"), *[c(f"{p}{i}").alias(p) for p in parts]) for i, n in enumerate(names)
    ]
    moments = df.agg(*aggs).select(F.inline(F.array(*rows)))
    levels = quantiles(df, names, [0.25, 0.5, 0.75]).select(
        "column", c("q")[0].alias("q25"), c("q")[1].alias("median"), c("q")[2].alias("q75")
    )
    # Both sides hold one row per column of the table.
    joined = moments.join(F.broadcast(levels), "column", "left")
    return joined.select("column", "n", "mean", "std", "min", "q25", "median", "q75", "max")


def row_col_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def target_rate(df: DataFrame, group: str | Sequence[str], target: str) -> DataFrame:
    """Mean target per group, with the group size."""
    keys = [group] if isinstance(group, str) else list(group)
    return known(df, *keys).groupBy(*[c(k) for k in keys]).agg(
        F.avg(c(target).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")
    )


def top_rate(df: DataFrame, group: str, target: str, n: int = 15) -> DataFrame:
    """The ``n`` groups with the highest rate; ties by group value."""
    rates = target_rate(df, group, target)
    return rates.select(c(group), "rate").orderBy(F.desc("rate"), c(group)).limit(n)


def top_n(df: DataFrame, by: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(c(by).desc_nulls_last(), *[c(t) for t in tie]).limit(n)


def group_by_target_counts(df: DataFrame, col: str, target: str, top: int = 10) -> DataFrame:
    """Counts by target class for the most frequent values of ``col``."""
    counts = known(df, col).groupBy(c(col)).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(c(target) == 0).alias("target_0"),
        F.count_if(c(target) == 1).alias("target_1"),
    )
    return counts.orderBy(F.desc("_n"), c(col)).limit(top).drop("_n")


def crosstab_share(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Row-normalised cross-tabulation over the listed column values."""
    counts = known(df, row).groupBy(c(row)).agg(
        F.count_if(c(col).isin(list(values))).alias("_all"),
        *[F.count_if(c(col) == F.lit(v)).alias(f"share_{v}") for v in values],
    )
    return counts.select(c(row), *[F.try_divide(c(f"share_{v}"), c("_all")).alias(f"share_{v}") for v in values])


def channel_stats(
    df: DataFrame,
    key: str = "channelId",
    video: str = "video_id",
    target: str = "is_trending",
    views: str = "view_count",
    flag: str = "is_verified",
    order: str = "video_id",
) -> DataFrame:
    """Per channel: videos, trending videos, rate, mean views, first known flag in ``order``."""
    return known(df, key).groupBy(c(key)).agg(
        F.count(c(video)).alias("video_count"),
        F.sum(c(target).cast("bigint")).alias("trending_count"),
        F.avg(c(target).cast("double")).alias("trending_rate"),
        F.avg(c(views).cast("double")).alias("avg_views"),
        F.min_by(c(flag), F.when(c(flag).isNotNull(), c(order))).alias(flag),
    )


def pivot_rate(df: DataFrame, row: Column, col: Column, target: str, labels: Mapping[object, str]) -> DataFrame:
    """Grid of mean target: ``row`` values down, the labelled ``col`` values across."""
    hit = {label: F.avg(F.when(col == F.lit(v), c(target).cast("double"))) for v, label in labels.items()}
    return df.filter(row.isNotNull()).groupBy(row.alias("row")).agg(*[e.alias(label) for label, e in hit.items()])


def period_summary(df: DataFrame, period: Column, target: str, count: str) -> DataFrame:
    """Rate and volume per period."""
    return df.filter(period.isNotNull()).groupBy(period.alias("period")).agg(
        F.avg(c(target).cast("double")).alias("trending_rate"), F.count(c(count)).alias("video_count")
    )


def kpis(df: DataFrame, target: str, log_views: str, comment_rate: str) -> DataFrame:
    """Headline figures; views are stored as log1p and turned back."""
    return df.agg(
        F.count(F.lit(1)).alias("total_videos"),
        F.avg(c(target).cast("double")).alias("trending_rate"),
        F.avg(F.expm1(c(log_views))).alias("avg_views"),
        F.avg(c(comment_rate)).alias("avg_comment_rate"),
    )


def group_median(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """(group, column, median) in long form."""
    long = quantiles(known(df, group), cols, [0.5], by=[group])
    return long.select(c(group), "column", c("q")[0].alias("median"))


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive."""
    p = F.avg(c(target).cast("double"))
    return df.agg(F.try_divide(F.lit(1.0) - p, p).alias("ratio"))
