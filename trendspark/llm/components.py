"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.arrow import drop_stored, stored_at


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of an undirected graph, ``root`` the smallest node of its component.

    Each round points nodes at smaller ones and is written to the shared folder; the rounds end when the stars stay as
    they are. Loops and repeated edges do no harm; a graph without edges has no rows.
    """
    x, y = F.col(a), F.col(b)
    links = edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    told = F.bit_xor(F.xxhash64("u", "v")), F.count("*")
    now, path = stored_at(links, "links")
    state = tuple(now.agg(*told).first())
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, the minima are joined by an exchange of their own; Spark can then split the star of a large component.
        lower, lower_path = stored_at(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
        large = both.join(lower, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, large_path = stored_at(large, "links")
        least, least_path = stored_at(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        pointed = large.join(least, "u")
        small = pointed.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        after, next_path = stored_at(small, "links")
        next_state = tuple(after.agg(*told).first())
        drop_stored(edges.sparkSession, path, lower_path, large_path, least_path)
        now, path = after, next_path
        if next_state == state:
            break
        state = next_state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
