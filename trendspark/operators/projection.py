"""Column-level reshaping: rename, align, flag, ratio, select by rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.session import c


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def add_metadata(df: DataFrame, is_trending: bool, today: str) -> DataFrame:
    return df.withColumns({"is_trending": F.lit(is_trending), "trending_date": F.lit(today)})


def align_columns(df: DataFrame, reference: T.StructType) -> DataFrame:
    """Columns of ``reference`` in its order and types; missing ones are null, others go.

    A simple value that does not fit the wanted type is null.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def aligned(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if have[f.name] == f.dataType:
            return c(f.name)
        simple = isinstance(have[f.name], T.AtomicType) and isinstance(f.dataType, T.AtomicType)
        return (c(f.name).try_cast(f.dataType) if simple else c(f.name).cast(f.dataType)).alias(f.name)

    return df.select(*[aligned(f) for f in reference.fields])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop those present, ignore the rest. Names are exact, dots included."""
    gone = set(cols)
    return df.select(*[c(n) for n in df.columns if n not in gone])


def combine_first(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """``first`` where not null, else ``second``; both inputs are dropped."""
    kept = [c(n) for n in df.columns if n not in (first, second)]
    return df.select(*kept, F.coalesce(c(first), c(second)).alias(out))


def engagement_ratios(
    df: DataFrame, ratios: Mapping[str, str], denominator: str = "view_count", plus_one: bool = False
) -> DataFrame:
    """``ratios`` maps a count column to its ratio column; a zero denominator gives null."""
    den = c(denominator) + 1 if plus_one else c(denominator)
    return df.withColumns({out: F.try_divide(c(num).cast("double"), den.cast("double")) for num, out in ratios.items()})


def presence_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """1 where the count is positive, else 0 (null counts as 0)."""
    return df.withColumns({out: F.coalesce((c(col) > 0).cast("int"), F.lit(0)) for col, out in flags.items()})


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def names_by_rule(df: DataFrame, include: Callable[[T.StructField], bool], exclude: Sequence[str] = ()) -> list[str]:
    gone = set(exclude)
    return [f.name for f in df.schema.fields if include(f) and f.name not in gone]


def select_by_rule(
    df: DataFrame, include: Callable[[T.StructField], bool] = is_numeric, exclude: Sequence[str] = ()
) -> DataFrame:
    """Columns whose schema field passes ``include``, minus ``exclude``."""
    return df.select(*[c(n) for n in names_by_rule(df, include, exclude)])


def embedding_columns(df: DataFrame) -> list[str]:
    """Columns holding embeddings, by name; the embeddable flag is not one."""
    return [n for n in df.columns if "emb" in n and "embeddable" not in n]
