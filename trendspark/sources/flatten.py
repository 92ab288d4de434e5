"""Nested API items to a flat table: one select built from the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

THUMBNAIL_URL = ("snippet", "thumbnails", "default", "url")


def _leaves(kind: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    for field in kind.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, here)
        else:
            out.append(here)
    return out


def _at(path: tuple[str, ...]) -> Column:
    col = F.col(f"`{path[0]}`")
    for name in path[1:]:
        col = col.getField(name)
    return col


def flat_name(path: tuple[str, ...]) -> str | None:
    """Output name of a leaf: None for dropped thumbnails, the leaf for two levels, else the dotted path."""
    if path == THUMBNAIL_URL:
        return "thumbnail_link"
    if "thumbnails" in path:
        return None
    return path[-1] if len(path) == 2 else ".".join(path)


def flatten_items(df: DataFrame) -> DataFrame:
    """Structs are walked, arrays stay arrays, nothing is shuffled."""
    named = [(flat_name(p), p) for p in _leaves(df.schema)]
    return df.select(*[_at(p).alias(name) for name, p in named if name is not None])
