"""Numeric expressions that treat NaN as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendspark.session import c


def known_number(name: str) -> Column:
    """A column as a double; NaN is null."""
    x = c(name).cast("double")
    return F.when(~F.isnan(x), x)
