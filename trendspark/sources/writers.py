"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.session import c


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is all a CSV cell can hold."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[F.to_json(c(f.name)).alias(f.name) if isinstance(f.dataType, nested) else c(f.name) for f in df.schema.fields]
    )


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Write without an index column; parquet between stages, CSV or JSON at the edge."""
    out = csv_ready(df) if fmt == "csv" else df
    writer = out.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_progress(df: DataFrame, path: str) -> None:
    """Append JSON lines; each call adds files, none is rewritten."""
    df.write.mode("append").json(path)


def write_checks(checks: DataFrame, path: str) -> None:
    """Append validation results with the time of the run."""
    checks.withColumn("checked_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_decision_log(log: DataFrame, path: str) -> None:
    log.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
