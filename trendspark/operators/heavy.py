"""Lookups by a value that very many rows may share.

Values that make up a share of the rows are few, whatever the table: they go to all tasks as a small map. The other
values meet their rows in a shuffle, in which the rows already served are dealt evenly and match nothing, so no task gets
the rows of a frequent value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.session import c

# At most one in HEAVY_SHARE values is heavy: 1,000.
HEAVY_SHARE = 0.001
_SPREAD = 1 << 20


def heavy_condition(weight: str, total: Column | int) -> Column:
    """Values of at least HEAVY_SHARE of all rows; no more than 1 / HEAVY_SHARE values are."""
    return c(weight) >= F.lit(HEAVY_SHARE) * total


def split_lookup(rows: DataFrame, key: Column, heavy: DataFrame, light: DataFrame, on: str, values: Sequence[str]) -> DataFrame:
    """Append ``values`` of the row of ``heavy`` or ``light`` whose ``on`` equals ``key``; null without one.

    Both tables are unique on ``on`` and share no value; ``heavy`` holds values of a share of the rows each.
    """
    # Names of its own, whatever the columns of the rows are called.
    own = "_lookup"
    while any(n.startswith(own) for n in rows.columns):
        own = f"_{own}"
    key_, hit, on_, rest, deal, at = (f"{own}_{n}" for n in ("key", "heavy", "on", "light", "deal", "at"))
    told = heavy.select(c(on).alias(hit), *[c(v).alias(f"{own}_h_{v}") for v in values])
    served = rows.withColumn(key_, key).join(F.broadcast(told), c(key_) == c(hit), "left")
    done = c(hit).isNotNull() | c(key_).isNull()
    # Served rows are dealt out by their task and content; unlike random numbers these are the same when a task runs again.
    plain = [c(f.name) for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = 1 + F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.lit(_SPREAD))
    dealt = served.withColumn(rest, F.when(~done, c(key_))).withColumn(deal, F.when(done, spread).otherwise(F.lit(0)).cast("bigint"))
    # Always 0; written as 0, it would turn into a filter and leave the shuffle to the value alone.
    zero = F.pmod(F.xxhash64(c(on)), F.lit(1)).cast("bigint").alias(at)
    others = light.select(c(on).alias(on_), zero, *[c(v).alias(f"{own}_l_{v}") for v in values])
    joined = dealt.join(others, (c(rest) == c(on_)) & (c(deal) == c(at)), "left")
    found = [F.when(c(hit).isNotNull(), c(f"{own}_h_{v}")).otherwise(c(f"{own}_l_{v}")).alias(v) for v in values]
    return joined.select(*[c(n) for n in rows.columns], *found)
