"""Concentration curves and ordered reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.operators.prefix import running_totals
from trendspark.session import c


def lorenz(stats: DataFrame, key: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rank keys by value (largest first, ties by key); cumulative share of keys and of value.

    Columns in ``keep`` travel along.
    """
    rows = stats.select(c(key), c(value), *[c(n) for n in keep])
    ranked = running_totals(
        rows,
        [c(value).desc_nulls_last(), c(key).asc()],
        {"rank": F.lit(1).cast("bigint"), "cum_value": F.coalesce(c(value), F.lit(0))},
        grand={"rank": "n_keys", "cum_value": "total"},
    )
    return ranked.select(
        c(key),
        c(value),
        *[c(n) for n in keep],
        "rank",
        (c("rank") / c("n_keys") * 100).alias("cum_pct_keys"),
        (F.try_divide(c("cum_value").cast("double"), c("total").cast("double")) * 100).alias("cum_pct_value"),
    )


def top_share(stats: DataFrame, key: str, value: str, fraction: float = 0.1) -> DataFrame:
    """Share of the total held by the first floor(n * fraction) keys."""
    ranked = running_totals(
        stats.select(c(key), c(value)),
        [c(value).desc_nulls_last(), c(key).asc()],
        {"rank": F.lit(1).cast("bigint")},
        grand={"rank": "n_keys"},
    )
    head = c("rank") <= F.floor(c("n_keys") * F.lit(fraction))
    held = F.coalesce(F.sum(F.when(head, c(value))), F.lit(0)).cast("double")
    return ranked.agg(
        F.count_if(head).alias("top_keys"),
        (F.try_divide(held, F.sum(c(value)).cast("double")) * 100).alias("share_pct"),
    )


def period_delta(periods: DataFrame, period: str, rate: str) -> DataFrame:
    """Change of rate from the previous present period. Periods are calendar units, a bounded set."""
    w = Window.orderBy(c(period))
    delta = c(rate) - F.lag(c(rate)).over(w)
    return periods.select(c(period), c(rate), delta.alias("delta"), (delta >= 0).alias("is_up"))


def peak_per_group(df: DataFrame, group: str, slot: str, target: str) -> DataFrame:
    """Slot with the best mean target for each group; the earliest wins a tie."""
    grid = df.groupBy(c(group), c(slot)).agg(F.avg(c(target).cast("double")).alias("rate"))
    return grid.groupBy(c(group)).agg(
        F.max_by(c(slot), F.struct(c("rate"), -c(slot))).alias("peak"), F.max("rate").alias("peak_rate")
    )
