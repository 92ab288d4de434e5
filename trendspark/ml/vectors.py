"""Feature vectors at the ML edge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame

from trendspark.session import c


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns to one vector; rows with a null are skipped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def from_array(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(c(col).cast("array<double>")))


def to_array(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, vector_to_array(c(col)))


def expand(df: DataFrame, vec: str, size: int, prefix: str) -> DataFrame:
    """One column per vector element: prefix0, prefix1, ..."""
    arr = vector_to_array(c(vec)) if df.schema[vec].dataType.typeName() == "vectorudt" else c(vec)
    return df.select(*[c(n) for n in df.columns if n != vec], *[arr[i].cast("double").alias(f"{prefix}{i}") for i in range(size)])
