"""Class rebalancing. Which rows are copied, dropped or interpolated follows key hashes, so runs repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.functions.hashing import hash_unit
from trendspark.operators.neighbors import Search, knn_join
from trendspark.operators.sampling import _class_sizes, sample_n
from trendspark.session import c, durable


def _minority_majority(df: DataFrame, target: str) -> tuple[object, int, object, int]:
    """Smallest and largest class with their sizes (classes are few); ties by class value."""
    sizes = sorted(_class_sizes(df.filter(c(target).isNotNull()), target).items(), key=lambda kv: (kv[1], kv[0]))
    if len(sizes) < 2:
        raise ValueError("rebalancing needs at least two classes")
    (low, n_low), (high, n_high) = sizes[0], sizes[-1]
    return low, n_low, high, n_high


def over_sample(df: DataFrame, target: str, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Repeat minority rows until the class matches the largest one, exactly.

    Every row gets the whole number of copies; the remainder goes to the rows of smallest hash.
    """
    low, n_low, _, n_high = _minority_majority(df, target)
    minority, rest = df.filter(c(target) == F.lit(low)), df.filter(~c(target).eqNullSafe(F.lit(low)))
    whole, extra = divmod(n_high, n_low)
    repeated = minority.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(whole)))).drop("_copy")
    out = rest.unionByName(repeated)
    return out.unionByName(sample_n(minority, extra, key, seed)) if extra else out


def under_sample(df: DataFrame, target: str, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Keep as many majority rows as the smallest class has."""
    _, n_low, high, _ = _minority_majority(df, target)
    majority, rest = df.filter(c(target) == F.lit(high)), df.filter(~c(target).eqNullSafe(F.lit(high)))
    return rest.unionByName(sample_n(majority, n_low, key, seed))


def smote(
    df: DataFrame, vec: str, target: str, key: str, k: int = 5, seed: int = 42, search: Search = knn_join
) -> DataFrame:
    """Add synthetic minority rows on segments to one of the k nearest minority rows until classes match.

    ``search`` finds the neighbours: exactly, or with ``graph_join`` at a cost that does not grow with the class per row.

    Output: (key as text, target, vec); a synthetic key is 'smote-<row>-<copy>'.
    """
    low, n_low, _, n_high = _minority_majority(df, target)
    original = df.select(c(key).cast("string").alias(key), c(target), c(vec).cast("array<double>").alias(vec))
    missing = n_high - n_low
    if missing == 0 or n_low < 2:
        return original
    minority = original.filter(c(target) == F.lit(low))
    k = min(k, n_low - 1)
    pairs = search(minority, minority, vec, k, key, key, exclude_self=True)

    whole, extra = divmod(missing, n_low)
    seeds = minority.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(whole)))) if whole else None
    if extra:
        tail = sample_n(minority, extra, key, seed).withColumn("_copy", F.lit(whole + 1))
        seeds = tail if seeds is None else seeds.unionByName(tail)
    drawn = (
        seeds.withColumn("_pick", F.floor(hash_unit([key, "_copy"], seed) * k).cast("int") + 1)
        .withColumn("_gap", hash_unit([key, "_copy"], seed + 1))
        .withColumnRenamed(vec, "_from")
    )
    towards = drawn.join(pairs, (c(key) == c("qid")) & (c("_pick") == c("rank")))
    ends = minority.select(c(key).alias("_end"), c(vec).alias("_to"))
    segments = towards.join(ends, c("bid") == c("_end"))
    point = F.zip_with("_from", "_to", lambda a, b: a + (b - a) * c("_gap"))
    synthetic = segments.select(
        F.concat_ws("-", F.lit("smote"), c(key), c("_copy")).alias(key), c(target), point.alias(vec)
    )
    return original.unionByName(synthetic)


def tomek_pairs(df: DataFrame, vec: str, target: str, key: str, search: Search = knn_join) -> DataFrame:
    """(a, b, target_a, target_b): mutual nearest rows of different classes, a < b."""
    near = search(df, df, vec, 1, key, key, exclude_self=True)
    classes = df.select(c(key).alias("_id"), c(target).alias("_class"))
    links = near.select(c("qid"), c("bid"))
    mutual = links.filter("qid < bid").alias("f").join(
        links.filter("qid > bid").alias("g"),
        (F.col("f.qid") == F.col("g.bid")) & (F.col("f.bid") == F.col("g.qid")),
    )
    pairs = mutual.select(F.col("f.qid").alias("a"), F.col("f.bid").alias("b"))
    pairs = pairs.join(classes.withColumnsRenamed({"_id": "a", "_class": "target_a"}), "a")
    pairs = pairs.join(classes.withColumnsRenamed({"_id": "b", "_class": "target_b"}), "b")
    return pairs.filter("target_a <> target_b").select("a", "b", "target_a", "target_b")


def tomek_links(
    df: DataFrame, vec: str, target: str, key: str, remove: str = "majority", search: Search = knn_join
) -> DataFrame:
    """Remove the members of links: all that are not of the smallest class, or with ``remove='all'`` both."""
    low, *_ = _minority_majority(df, target)
    pairs = tomek_pairs(df, vec, target, key, search)
    ends = pairs.select(c("a").alias("_gone"), c("target_a").alias("_class")).unionByName(
        pairs.select(c("b").alias("_gone"), c("target_b").alias("_class"))
    )
    if remove == "majority":
        ends = ends.filter(c("_class") != F.lit(low))
    return df.join(ends.select("_gone"), c(key) == c("_gone"), "left_anti")


def smote_tomek(
    df: DataFrame, vec: str, target: str, key: str, k: int = 5, seed: int = 42, search: Search = knn_join
) -> DataFrame:
    grown = durable(smote(df, vec, target, key, k, seed, search), "smote")
    return tomek_links(grown, vec, target, key, remove="all", search=search)


def class_weights(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Append n / (classes * class size) to every row."""
    sizes = _class_sizes(df.filter(c(target).isNotNull()), target)
    n, classes = sum(sizes.values()), len(sizes)
    weight = F.lit(None).cast("double")
    for value, size in sorted(sizes.items()):
        weight = F.when(c(target) == F.lit(value), F.lit(n / (classes * size))).otherwise(weight)
    return df.withColumn(out, weight)


def resample(df: DataFrame, mode: str | None, vec: str, target: str, key: str, seed: int = 42) -> DataFrame:
    """Dispatch by name; an unknown mode (also 'balanced') returns the input."""
    if mode == "over":
        return over_sample(df, target, key, seed)
    if mode == "under":
        return under_sample(df, target, key, seed)
    if mode == "smote":
        return smote(df, vec, target, key, seed=seed)
    if mode == "tomek":
        return tomek_links(df, vec, target, key)
    return df
