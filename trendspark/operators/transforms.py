"""Value transforms: logs, capping, casting, filling, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.numbers import known_number
from trendspark.functions.text import as_bool
from trendspark.operators.distribution import fences
from trendspark.operators.filters import number
from trendspark.operators.quantiles import quantile_map
from trendspark.session import c

# The count column whose cap is a constant range, and that range.
FIXED_CAPS = {"chapter_count": (0, 20)}


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in cols if n in have]


def log_transform(df: DataFrame, cols: Sequence[str], base: str = "natural") -> DataFrame:
    """log(x+1) with negatives taken as 0; absent columns are skipped."""
    log = {"natural": F.log1p, "log2": lambda x: F.log2(x + 1), "log10": lambda x: F.log10(x + 1)}[base]

    def clipped(name: str) -> Column:
        x = known_number(name)
        return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))

    return df.withColumns({n: log(clipped(n)) for n in _present(df, cols)})


def sqrt_transform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Square root; a column with any negative value is left as it is."""
    names = _present(df, cols)
    if not names:
        return df
    low = df.agg(*[F.min(c(n)) for n in names]).first()
    return df.withColumns({n: F.sqrt(c(n).cast("double")) for n, lo in zip(names, low, strict=True) if lo is None or lo >= 0})


def inverse_log(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, F.expm1(c(col)))


def clip(col: Column, lo: float | None, hi: float | None) -> Column:
    """Bound a value; null stays null (``least`` and ``greatest`` skip nulls)."""
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(col.isNotNull(), out)


def clip_upper(df: DataFrame, col: str, cap: float, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, clip(c(col), None, cap))


def cap_bounds(
    df: DataFrame,
    cols: Sequence[str],
    method: str = "iqr",
    k: float = 1.5,
    z: float = 3.0,
    fixed: Mapping[str, tuple[float, float]] | None = None,
) -> dict[str, tuple[float, float]]:
    """Fences per present column; an unknown method gives fixed ranges only."""
    fixed = FIXED_CAPS if fixed is None else fixed
    names = _present(df, cols)
    fitted = [n for n in names if n not in fixed]
    out = {n: tuple(fixed[n]) for n in names if n in fixed}
    if fitted and method in ("iqr", "zscore"):
        out.update(fences(df, fitted, method, k, z))
    return out


def apply_caps(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({n: clip(c(n), lo, hi) for n, (lo, hi) in bounds.items()})


def cap_outliers(df: DataFrame, cols: Sequence[str], method: str = "iqr", k: float = 1.5, z: float = 3.0) -> DataFrame:
    """Clip to outlier fences; all fences come from one aggregate."""
    return apply_caps(df, cap_bounds(df, cols, method, k, z))


def cast_types(df: DataFrame, ints: Sequence[str], bools: Sequence[str]) -> DataFrame:
    """Numbers or null; 'true' in any case is true and all else false."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def whole(name: str) -> Column:
        x = c(name).cast("double") if isinstance(kinds[name], T.NumericType) else number(c(name))
        return x.try_cast("bigint")

    return df.withColumns(
        {n: whole(n) for n in _present(df, ints)} | {n: as_bool(c(n)) for n in _present(df, bools)}
    )


def fill_when(df: DataFrame, col: str, condition: Column, value: object) -> DataFrame:
    """Fill nulls of ``col`` on rows meeting ``condition``; the value takes the column's type."""
    filled = F.lit(value).cast(df.schema[col].dataType)
    return df.withColumn(col, F.when(c(col).isNull() & condition, filled).otherwise(c(col)))


def fill_text(df: DataFrame, cols: Sequence[str], value: str = "", empty_too: bool = False) -> DataFrame:
    """Null text to ``value``; with ``empty_too`` also empty text."""

    def filled(name: str) -> Column:
        text = c(name).cast("string")
        if empty_too:
            text = F.when(text != "", text)
        return F.coalesce(text, F.lit(value))

    return df.withColumns({n: filled(n) for n in _present(df, cols)})


def zscore(df: DataFrame, cols: Sequence[str], ddof: int = 1, suffix: str = "_z") -> DataFrame:
    """Standard score per column; zero spread gives null."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[F.struct(F.avg(known_number(n)), sd(known_number(n))) for n in cols]).first()
    scores = {}
    for name, (mean, spread) in zip(cols, row, strict=True):
        usable = mean is not None and spread not in (None, 0.0)
        scores[name + suffix] = (known_number(name) - mean) / spread if usable else F.lit(None).cast("double")
    return df.withColumns(scores)


@dataclass(frozen=True)
class RobustScale:
    """(x - median) / IQR with parameters of the table it was fitted on."""

    params: Mapping[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> RobustScale:
        q = quantile_map(df, cols, [0.25, 0.5, 0.75])
        params = {}
        for n in cols:
            q1, mid, q3 = q[n, 0.25], q[n, 0.5], q[n, 0.75]
            if mid is not None:
                params[n] = (mid, (q3 - q1) or 1.0)
        return cls(params)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: (c(n).cast("double") - mid) / iqr for n, (mid, iqr) in self.params.items()})


def scalable_columns(df: DataFrame, target: str, protected: Sequence[str]) -> list[str]:
    """Columns to scale: not the target, not protected, not principal components."""
    gone = {target, *protected}
    return [n for n in df.columns if n not in gone and "pca" not in n]
