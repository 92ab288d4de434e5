"""Reproducible pseudo-randomness: md5 of key and seed, the same on any partitioning and engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendspark.session import c


def keyed_hash(key: str | Sequence[str], seed: int) -> Column:
    """Hex md5 of the key columns (joined by '|') followed by the seed."""
    names = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[c(n).cast("string") for n in names])
    return F.md5(F.concat(text, F.lit(str(seed))))


def hash_fraction_bucket(key: str | Sequence[str], seed: int, buckets: int) -> Column:
    """Uniform bucket 0..buckets-1 from the first 32 hash bits."""
    return F.conv(F.substring(keyed_hash(key, seed), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def hash_unit(key: str | Sequence[str], seed: int) -> Column:
    """Uniform double in [0, 1) from the first 32 hash bits."""
    return F.conv(F.substring(keyed_hash(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
