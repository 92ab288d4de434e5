"""Distribution statistics: histograms, densities, box plots, correlation, skew, outliers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.functions.numbers import known_number
from trendspark.operators.heavy import heavy_condition, split_lookup
from trendspark.operators.prefix import running_totals
from trendspark.operators.quantiles import quantile_map, quantiles
from trendspark.session import c, durable


def log1p_columns(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c(k) for k in keep], *[F.log1p(known_number(n)).alias(n) for n in cols])


def box_stats(df: DataFrame, group: str, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (furthest value inside the fences) and outliers, per group and column."""
    df = df.filter(c(group).isNotNull())
    boxes = quantiles(df, cols, [0.25, 0.5, 0.75], by=[group]).select(
        c(group), "column", "n", *[c("q")[i].alias(n) for i, n in enumerate(["q1", "median", "q3"])]
    )
    boxes = boxes.withColumn("_lo", c("q1") - k * (c("q3") - c("q1"))).withColumn(
        "_hi", c("q3") + k * (c("q3") - c("q1"))
    )
    boxes = durable(boxes, "boxes")
    cells = F.array(*[F.struct(F.lit(n).alias("column"), known_number(n).alias("value")) for n in cols])
    long = df.select(c(group), F.inline(cells)).filter("value is not null")
    inside = (c("value") >= c("_lo")) & (c("value") <= c("_hi"))
    return (
        long.join(boxes, [group, "column"])
        .groupBy(c(group), "column", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, c("value"))).alias("whisker_low"),
            F.max(F.when(inside, c("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def _bin_index(value: Column, lo: float, hi: float, bins: int) -> Column:
    width = (hi - lo) / bins
    return F.least(F.floor((value - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """(bin, lo, hi, n) over equal-width bins between min and max; the last bin is closed."""
    x = known_number(col)
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    counts = (
        df.filter(x.isNotNull())
        .groupBy(_bin_index(x, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / bins
    frame = df.sparkSession.range(bins).select(c("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + c("bin") * width).alias("lo"),
        (F.lit(low) + (c("bin") + 1) * width).alias("hi"),
        F.coalesce(c("n"), F.lit(0)).alias("n"),
    )


def kde_grid(df: DataFrame, group: str, col: str, grid: int = 200, bins: int = 1024, cut: float = 3.0) -> DataFrame:
    """Gaussian density of ``col`` per group on ``grid`` points (Scott bandwidth).

    The kernel runs over a fine histogram, so its cost does not grow with the
    rows. Groups are classes of a target: each contributes bins x grid cells.
    """
    x = known_number(col)
    rows = df.select(c(group).alias("grp"), x.alias("x")).filter("x is not null and grp is not null")
    stats = durable(
        rows.groupBy("grp")
        .agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .filter("sd > 0")
        .withColumn("bw", c("sd") * F.pow(c("n").cast("double"), F.lit(-0.2)))
        .withColumn("bin_width", (c("hi") - c("lo")) / bins),
        "kde",
    )
    located = rows.join(stats, "grp").select(
        "grp", F.least(F.floor((c("x") - c("lo")) / c("bin_width")).cast("int"), F.lit(bins - 1)).alias("bin")
    )
    cells = located.groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("cnt")).join(stats, "grp")
    points = cells.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    start = c("lo") - cut * c("bw")
    step = (c("hi") - c("lo") + 2 * cut * c("bw")) / (grid - 1)
    centre = c("lo") + (c("bin") + 0.5) * c("bin_width")
    points = points.withColumn("at", start + c("point") * step)
    z = (c("at") - centre) / c("bw")
    kernel = F.exp(-0.5 * z * z) * c("cnt") / (c("n") * c("bw") * math.sqrt(2 * math.pi))
    return points.groupBy("grp", "point", "at").agg(F.sum(kernel).alias("density"))


def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for every pair of columns, in one pass."""
    pairs = list(combinations(cols, 2))

    def both(a: str, b: str) -> Column:
        return F.corr(known_number(a), known_number(b))

    row = df.agg(*[both(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), c(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*cells)))


def corr_matrix_log(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return pearson(log1p_columns(df, cols), cols)


def average_ranks(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, cnt, avg_rank): ties share the mean of the ranks they span."""
    counts = (
        df.select(*[c(b) for b in by], c(col).alias("value"))
        .filter("value is not null")
        .groupBy(*[c(b) for b in by], "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    ranked = running_totals(counts, ["value"], {"upto": c("cnt")}, by=by)
    return ranked.select(*[c(b) for b in by], "value", "cnt", (c("upto") - (c("cnt") - 1) / 2).alias("avg_rank"))


def average_rank(df: DataFrame, col: str, out: str = "avg_rank") -> DataFrame:
    """Append the average rank of ``col`` to every row; null values get a null rank."""
    ranks = durable(average_ranks(df, col).select("value", "cnt", c("avg_rank").alias(out)), "ranks")
    total = ranks.agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]
    often = heavy_condition("cnt", F.lit(total))
    return split_lookup(df, c(col), ranks.filter(often), ranks.filter(~often), "value", [out])


def _row_sets(numbers: DataFrame, pairs: Sequence[tuple[int, int]]) -> list[tuple[set[int], list[tuple[int, int]]]]:
    """Pairs of columns by the rows in which both are known: (columns, pairs), each set with rows of its own."""
    used = sorted({i for pair in pairs for i in pair})
    known = F.lit(0).cast("bigint")
    for place, i in enumerate(used):
        known = known + F.when(c(f"v{i}").isNotNull(), F.lit(1 << place)).otherwise(F.lit(0))
    bit = {i: 1 << place for place, i in enumerate(used)}
    # One row per combination of known columns.
    patterns = numbers.groupBy(known.alias("known")).agg(F.count(F.lit(1)).alias("n")).collect()

    def rows(columns: set[int]) -> int:
        wanted = sum(bit[i] for i in columns)
        return sum(r["n"] for r in patterns if r["known"] & wanted == wanted)

    sets: list[tuple[set[int], list[tuple[int, int]]]] = []
    for pair in pairs:
        for columns, mine in sets:
            if rows(columns) == rows(set(pair)) == rows(columns | set(pair)):
                columns |= set(pair)
                mine.append(pair)
                break
        else:
            sets.append((set(pair), [pair]))
    return sets


def spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) rank correlation over the rows where both values are present; NaN is missing.

    Columns are ranked once for each set of rows in which pairs are known. Up to 62 columns.
    """
    pairs = list(combinations(range(len(cols)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    numbers = df.select(*[known_number(n).alias(f"v{i}") for i, n in enumerate(cols)])
    sets = _row_sets(numbers, pairs)
    cells = []
    for s, (columns, _) in enumerate(sets):
        whole = " AND ".join(f"v{i} IS NOT NULL" for i in sorted(columns))
        cells += [f"named_struct('set', {s}, 'column', {i}, 'value', IF({whole}, v{i}, NULL))" for i in sorted(columns)]
    long = numbers.select(F.expr(f"inline(array({', '.join(cells)}))")).filter("value IS NOT NULL")
    sizes = long.groupBy("set", "column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = running_totals(sizes, ["value"], {"upto": c("cnt")}, by=["set", "column"], grand={"upto": "n"})
    # Centred on the mean rank (n+1)/2, so the moments below lose no precision.
    centred = F.expr("upto - (cnt - 1) / 2 - (n + 1) / 2").alias("d")
    ranks = durable(ranked.select("set", "column", "value", "cnt", "n", centred), "ranks")
    often = heavy_condition("cnt", c("n"))
    found = []
    for s, (columns, mine) in enumerate(sets):
        used = sorted(columns)
        rows = numbers.filter(" AND ".join(f"v{i} IS NOT NULL" for i in used)).select(*[f"v{i}" for i in used])
        for i in used:
            own = ranks.filter((c("set") == s) & (c("column") == i)).withColumnRenamed("d", f"d{i}")
            rows = split_lookup(rows, c(f"v{i}"), own.filter(often), own.filter(~often), "value", [f"d{i}"])
        aggs = [F.expr(f"sum(d{i} * d{i}) AS s{i}") for i in used] + [F.expr(f"sum(d{a} * d{b}) AS p{a}_{b}") for a, b in mine]
        named = [
            F.struct(F.lit(cols[a]).alias("a"), F.lit(cols[b]).alias("b"), F.expr(f"try_divide(p{a}_{b}, sqrt(s{a} * s{b}))").alias("r"))
            for a, b in mine
        ]
        found.append(rows.agg(*aggs).select(F.inline(F.array(*named))))
    return reduce(DataFrame.unionByName, found)


def skew(df: DataFrame, cols: Sequence[str], adjusted: bool = True) -> DataFrame:
    """(column, skew); the adjusted figure corrects for sample size."""
    aggs = []
    for i, name in enumerate(cols):
        x = known_number(name)
        aggs += [F.skewness(x).alias(f"s{i}"), F.count(x).cast("double").alias(f"n{i}")]
    cells = []
    for i, name in enumerate(cols):
        n, value = c(f"n{i}"), c(f"s{i}")
        if adjusted:
            value = F.when(n > 2, value * F.sqrt(n * (n - 1)) / (n - 2))
        cells.append(F.struct(F.lit(name).alias("column"), value.alias("skew")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def fences(
    df: DataFrame, cols: Sequence[str], method: str, k: float = 1.5, z: float = 3.0, ddof: int = 1
) -> dict[str, tuple[float, float]]:
    """Outlier fences per column on the driver: two numbers each. Columns without data are left out."""
    if method == "iqr":
        q = quantile_map(df, cols, [0.25, 0.75])
        out = {}
        for name in cols:
            q1, q3 = q[name, 0.25], q[name, 0.75]
            if q1 is not None and q3 is not None:
                out[name] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
        return out
    if method == "zscore":
        sd = F.stddev_samp if ddof == 1 else F.stddev_pop
        row = df.agg(*[F.struct(F.avg(known_number(n)), sd(known_number(n))) for n in cols]).first()
        return {n: (m - z * s, m + z * s) for n, (m, s) in zip(cols, row, strict=True) if m is not None and s is not None}
    raise ValueError(f"unknown outlier method {method!r}")


def outlier_bounds(
    df: DataFrame, cols: Sequence[str], method: str = "both", k: float = 1.5, z: float = 3.0, ddof: int = 0
) -> DataFrame:
    """(column, method, lower, upper, outliers) for IQR fences, z-scores, or both; one counting pass."""
    methods = ["iqr", "zscore"] if method == "both" else [method]
    bounds = [(n, m, *lohi) for m in methods for n, lohi in fences(df, cols, m, k, z, ddof).items()]
    if not bounds:
        return df.sparkSession.createDataFrame(
            [], "column string, method string, lower double, upper double, outliers bigint"
        )
    counts = df.agg(
        *[
            F.count_if((known_number(n) < lo) | (known_number(n) > hi)).alias(f"o{i}")
            for i, (n, _, lo, hi) in enumerate(bounds)
        ]
    )
    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(m).alias("method"),
            F.lit(lo).alias("lower"),
            F.lit(hi).alias("upper"),
            c(f"o{i}").alias("outliers"),
        )
        for i, (n, m, lo, hi) in enumerate(bounds)
    ]
    return counts.select(F.inline(F.array(*cells)))


def columns_with_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    return outlier_bounds(df, cols, "iqr", k).filter("outliers > 0").select("column", "outliers")
