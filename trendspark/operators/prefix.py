"""Running totals over a whole table, without ever bringing it to one task.

Rows are range-partitioned on the ordering (a hot ``by`` group spans many
partitions), the partition number is written next to each row, and each
partition then needs only the totals of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.session import c, durable


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    grand: Mapping[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add inclusive running totals ``sums`` (name to summed expression) in ``order`` within ``by``.

    ``grand`` names further columns holding the group's full total of a sum.
    ``order`` must be unique within ``by``; aggregate ties away first.
    """
    grand = dict(grand or {})
    order_cols = [c(o) if isinstance(o, str) else o for o in order]
    groups = [c(b) for b in by]
    ranged = df.withColumns({f"_s_{k}": e for k, e in sums.items()})
    # Without a number, adaptive execution merges neighbouring small ranges; their order stays.
    width = [partitions] if partitions else []
    ranged = ranged.repartitionByRange(*width, *groups, *order_cols).withColumn("_part", F.spark_partition_id())
    # Sampled range bounds differ between runs, so the placement is written down once.
    ranged = durable(ranged, "ranged")

    totals = ranged.groupBy("_part", *groups).agg(*[F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums])
    # One row per partition and group: without groups at most as many as shuffle partitions.
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = totals.select(
        "_part",
        *groups,
        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums],
        *[F.sum(f"_t_{k}").over(whole).alias(f"_g_{k}") for k in grand],
    )
    if not by:
        offsets = F.broadcast(offsets)
    within = Window.partitionBy("_part", *groups).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_l_{k}": F.sum(f"_s_{k}").over(within) for k in sums})

    same = [F.col("l._part") == F.col("o._part")]
    same += [F.col(f"l.`{b}`").eqNullSafe(F.col(f"o.`{b}`")) for b in by]
    condition = same[0]
    for extra in same[1:]:
        condition = condition & extra
    joined = local.alias("l").join(offsets.alias("o"), condition)
    return joined.select(
        *[F.col(f"l.`{name}`") for name in df.columns],
        *[(F.col(f"l._l_{k}") + F.col(f"o._o_{k}")).alias(k) for k in sums],
        *[F.col(f"o._g_{k}").alias(name) for k, name in grand.items()],
    )
