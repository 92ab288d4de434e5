"""Reproducible sampling and splitting.

The n smallest key hashes are found by narrowing a hash prefix (4096 counters
per pass), so taking n of N rows is a filter on the scan, not a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.functions.hashing import hash_fraction_bucket, keyed_hash
from trendspark.operators.prefix import running_totals
from trendspark.session import c

_DIGITS = 3
_HASH_DIGITS = 32
_CELL_ROWS = 100_000
MAX_CLASSES = 1000


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def smallest_hashes(
    df: DataFrame, n: int, key: str | Sequence[str], seed: int, cell_rows: int = _CELL_ROWS
) -> tuple[Column, DataFrame | None]:
    """The n first rows by (hash, key) as a filter plus the rows to add at its edge.

    Returns the condition of rows taken whole and, where the cut falls inside a
    prefix cell, the part of that cell to take.
    """
    names = _names(key)
    digest = keyed_hash(names, seed)
    prefix, left, depth = "", n, 0
    while depth < _HASH_DIGITS:
        width = min(_DIGITS, _HASH_DIGITS - depth)
        cell = F.substring(digest, depth + 1, width)
        inside = df if not prefix else df.filter(digest.startswith(prefix))
        counts = sorted(inside.groupBy(cell.alias("p")).count().collect())  # at most 16**3 rows
        cut = None
        for part, rows in counts:
            if rows > left:
                cut = (part, rows)
                break
            left -= rows
        if cut is None:
            # Every row below the end of this prefix is wanted.
            return digest < F.lit(prefix + "g"), None
        prefix += cut[0]
        depth += width
        if left == 0:
            return digest < F.lit(prefix), None
        if cut[1] <= cell_rows:
            edge = df.filter(digest.startswith(prefix))
            return digest < F.lit(prefix), edge.orderBy(digest, *[c(k) for k in names]).limit(left)
    # Rows sharing one full hash share the key: number them by all columns, in parallel.
    tied = df.filter(digest == F.lit(prefix))
    others = [c(name) for name in df.columns]
    numbered = running_totals(tied, others, {"_nth": F.lit(1).cast("bigint")})
    return digest < F.lit(prefix), numbered.filter(c("_nth") <= left).drop("_nth")


def sample_n(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42, cell_rows: int = _CELL_ROWS) -> DataFrame:
    """Exactly min(n, rows) rows, those with the smallest key hash; up to ``cell_rows`` rows may be sorted by one task."""
    if n <= cell_rows:
        return df.orderBy(keyed_hash(key, seed), *[c(k) for k in _names(key)]).limit(n)
    below, edge = smallest_hashes(df, n, key, seed, cell_rows)
    taken = df.filter(below)
    return taken if edge is None else taken.unionByName(edge)


def _class_sizes(df: DataFrame, target: str) -> dict:
    """Rows per class; a target with more than MAX_CLASSES values is no class label."""
    found = df.groupBy(c(target)).count().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes")
    return {row[0]: row[1] for row in found}


def balanced_sample(df: DataFrame, target: str, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """All positives and as many hash-chosen negatives."""
    positives = df.filter(c(target) == 1)
    negatives = df.filter(c(target) == 0)
    return positives.unionByName(sample_n(negatives, positives.count(), key, seed))


def split3(
    df: DataFrame, key: str | Sequence[str], seed: int = 42, fractions: Sequence[int] = (60, 20, 20)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Disjoint train, validation and test parts by hash percentile; map-only."""
    train, val, _ = fractions
    bucket = hash_fraction_bucket(key, seed, 100)
    return (
        df.filter(bucket < train),
        df.filter((bucket >= train) & (bucket < train + val)),
        df.filter(bucket >= train + val),
    )


def split_label(key: str | Sequence[str], seed: int = 42, fractions: Sequence[int] = (60, 20, 20)) -> Column:
    """The part each row falls in, as text."""
    train, val, _ = fractions
    bucket = hash_fraction_bucket(key, seed, 100)
    return F.when(bucket < train, "train").when(bucket < train + val, "val").otherwise("test")
