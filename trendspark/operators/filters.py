"""Row filters and cross-column rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.text import as_bool
from trendspark.operators.quantiles import quantile_map
from trendspark.session import c


def number(col: Column) -> Column:
    """Numeric value or null; never raises."""
    return F.nullif(F.trim(col.cast("string")), F.lit("")).try_cast("double")


def _numeric(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c(name)), c(name))
    return c(name) if isinstance(kind, T.NumericType) else number(c(name))


def le_condition(df: DataFrame, small: str, big: str) -> Column:
    return F.coalesce(_numeric(df, small), F.lit(0)) <= F.coalesce(_numeric(df, big), F.lit(0))


def filter_le(df: DataFrame, small: str, big: str) -> DataFrame:
    """Keep rows with small <= big; null and unparseable count as 0."""
    return df.filter(le_condition(df, small, big))


def comment_state_condition(df: DataFrame, count: str, disabled: str) -> Column:
    n, off = _numeric(df, count), as_bool(c(disabled))
    return n.isNull() | F.when(off, n == 0).otherwise(n >= 0)


def filter_comment_state(df: DataFrame, count: str, disabled: str) -> DataFrame:
    """Keep null counts, non-negative counts while enabled, and zero while disabled."""
    return df.filter(comment_state_condition(df, count, disabled))


def complete(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """True where no listed column is null or NaN."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ok: Column = F.lit(True)
    for name in cols if cols is not None else df.columns:
        ok = ok & c(name).isNotNull()
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(c(name))
    return ok


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.filter(complete(df, cols))


def filter_iqr(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Rows inside the IQR fences. The fences are literals, so the filter reaches the scan."""
    q = quantile_map(df, [col], [0.25, 0.75])
    q1, q3 = q[col, 0.25], q[col, 0.75]
    if q1 is None:
        return df.limit(0)
    return df.filter((c(col) >= q1 - k * (q3 - q1)) & (c(col) <= q3 + k * (q3 - q1)))


def video_rules(df: DataFrame, strict_types: bool = False) -> dict[str, Column]:
    """Cross-column rules whose columns are all present: name to the violating condition.

    With ``strict_types`` a text 'True' is not a boolean, so it matches neither state.
    """
    have = set(df.columns)

    def disabled(value: bool) -> Column:
        if strict_types and not isinstance(df.schema["comments_disabled"].dataType, T.BooleanType):
            return F.lit(False)
        known = c("comments_disabled").isNotNull()
        return known & (as_bool(c("comments_disabled")) == F.lit(value))

    rules: dict[str, Column] = {}
    if {"is_trending", "trending_date"} <= have:
        trending = as_bool(c("is_trending")) | (number(c("is_trending")) == 1)
        rules["trending_without_date"] = F.coalesce(trending, F.lit(False)) & c("trending_date").isNull()
    if {"comments_disabled", "comment_count"} <= have:
        rules["disabled_with_comments"] = disabled(True) & ~_numeric(df, "comment_count").eqNullSafe(F.lit(0))
    if {"likes", "view_count"} <= have:
        rules["likes_above_views"] = _numeric(df, "likes") > _numeric(df, "view_count")
    rating = "contentDetails.contentRating.ytRating"
    if {rating, "comments_disabled"} <= have:
        rules["age_restricted_with_comments"] = (c(rating) == "ytAgeRestricted") & disabled(False)
    return rules


def violations(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per rule with the number of rows breaking it; a single pass."""
    chosen = dict(rules if rules is not None else video_rules(df))
    counts = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(chosen.values())])
    rows = [F.struct(F.lit(name).alias("rule"), c(f"r{i}").alias("violations")) for i, name in enumerate(chosen)]
    return counts.select(F.inline(F.array(*rows)))
