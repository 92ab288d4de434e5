"""Exact linear-interpolated quantiles from mergeable summaries.

One aggregate builds a rank summary per group and column, folded in each task and merged after the shuffle. Its values a
little below and above a wanted rank bracket the exact one. A second aggregate then counts the rows of each bracket by
value and everything between brackets as a whole, and a running count over these few cells finds the rank. Two scans
serve any number of columns, groups and probabilities, and the rows stay in the cluster. The running count tells whether
a rank lay in its bracket; if one did not, the values of its column are counted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.operators.prefix import running_totals
from trendspark.session import c, durable

# Ranks of a summary are off by at most one in so many.
ACCURACY = 10_000
_BELOW = float("-inf")


def _clean(name: str) -> Column:
    x = c(name).cast("double")
    return F.when(~F.isnan(x), x)


def _double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


# The aggregates below are written as SQL text: built from columns one by one, they would take longer than they run.


def _ends(probs: Sequence[float], accuracy: int) -> tuple[list[float], list[float]]:
    margin = 2 / accuracy
    return [max(p - margin, 0.0) for p in probs], [min(p + margin, 1.0) for p in probs]


def _summaries(rows: DataFrame, width: int, probs: Sequence[float], by: Sequence[str], accuracy: int) -> DataFrame:
    """(by..., n0, s0, n1, ...): rows of each column, and its values a little below and above each wanted rank."""
    levels = ", ".join(_double(p) for side in _ends(probs, accuracy) for p in side)
    aggs = []
    for i in range(width):
        aggs += [F.expr(f"count(_x{i}) AS n{i}"), F.expr(f"percentile_approx(_x{i}, array({levels}), {accuracy}) AS s{i}")]
    return rows.groupBy(*[c(b) for b in by]).agg(*aggs)


def _open_ends(values: str, n: str, probs: Sequence[float], accuracy: int, small_rows: int) -> list[str]:
    """SQL of the lower ends of all brackets, then of the upper ones. In few rows a bracket would be a row or two wide:
    there all values count.
    """
    lows, highs = _ends(probs, accuracy)
    open_ = [(_double(_BELOW), p <= 0) for p in lows] + [(_double(-_BELOW), p >= 1) for p in highs]
    return [far if always else f"IF({n} < {small_rows}, {far}, {values}[{j}])" for j, (far, always) in enumerate(open_)]


def _cell(i: int, lows: Sequence[str], highs: Sequence[str]) -> str:
    """A value inside a bracket stands for itself, any other for all values since the bracket below it."""
    inside = " OR ".join(f"_x{i} BETWEEN {a} AND {b}" for a, b in zip(lows, highs, strict=True))
    # Ends rise with the probability, so the last one below counts.
    below = " ".join(f"WHEN _x{i} > {b} THEN {b}" for b in reversed(highs))
    return f"named_struct('_i', {i}, '_x', _x{i}, '_v', CASE WHEN {inside} THEN _x{i} {below} ELSE {_double(_BELOW)} END)"


def _interpolated(found: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys..., n, q) from cells (keys..., n, _v, _gap, cnt, upto)."""
    picks, levels = [], []
    for i, p in enumerate(probs):
        pos = f"((n - 1) * {_double(p)})"
        for side, at in (("lo", f"floor({pos})"), ("hi", f"ceil({pos})")):
            # The value at 0-based position ``at`` is the one whose run covers it.
            picks.append(F.expr(f"max(IF(upto > {at} AND upto - cnt <= {at} AND _gap = 0, _v, NULL)) AS {side}{i}"))
        levels.append(f"IF(lo{i} = hi{i}, lo{i}, lo{i} + (hi{i} - lo{i}) * ({pos} - floor({pos})))")
    out = found.groupBy(*[c(g) for g in keys], "n").agg(*picks)
    return out.select(*[c(g) for g in keys], "n", F.expr(f"array({', '.join(levels)})").alias("q"))


def _ranked_cells(rows: DataFrame, ends: Sequence[Sequence[str]], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., _i, n, q) by one aggregate over the rows; a rank outside its bracket leaves a null level.

    ``ends`` has for each column the SQL of its lower and then its upper ends.
    """
    k = len(probs)
    cells = F.expr(f"inline(array({', '.join(_cell(i, e[:k], e[k:]) for i, e in enumerate(ends))}))")
    groups = [*by, "_i"]
    counted = (
        rows.select(*[c(b) for b in by], cells)
        .filter("_x IS NOT NULL")
        .groupBy(*[c(g) for g in groups], "_v", F.expr("IF(_v = _x, 0, 1) AS _gap"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    # A window holds the cells of one group and column: the values inside its brackets.
    upto = Window.partitionBy(*[c(g) for g in groups]).orderBy("_v", "_gap").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*[c(g) for g in groups])
    placed = counted.select("*", F.sum("cnt").over(upto).alias("upto"), F.sum("cnt").over(whole).alias("n"))
    return _interpolated(placed, groups, probs)


def _of_table(df: DataFrame, rows: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int, small_rows: int) -> dict[str, tuple[int, list]]:
    """{column: (n, levels)} of the whole table: a few numbers a column reach the driver."""
    first = _summaries(rows, len(cols), probs, (), accuracy).first()
    row = first.asDict()
    lows, highs = _ends(probs, accuracy)
    far = [p <= 0 for p in lows] + [p >= 1 for p in highs]
    ends = []
    for i in range(len(cols)):
        few = row[f"n{i}"] < max(small_rows, 1)
        widest = [_BELOW] * len(probs) + [-_BELOW] * len(probs)
        ends.append([_double(w if few or always else row[f"s{i}"][j]) for j, (w, always) in enumerate(zip(widest, far, strict=True))])
    found = {cols[r["_i"]]: (r["n"], r["q"]) for r in _ranked_cells(rows, ends, probs, ()).collect()}
    missed = [n for n, (_, q) in found.items() if None in q]
    if missed:
        found |= {r["column"]: (r["n"], r["q"]) for r in value_quantiles(df, missed, probs).collect()}
    return found


def _of_groups(df: DataFrame, rows: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int, small_rows: int) -> DataFrame:
    # Written, so that the planner sends the brackets to the rows only if they are small.
    ends = [_open_ends(f"s{i}", f"n{i}", probs, accuracy, small_rows) for i in range(len(cols))]
    named = [F.expr(f"{sql} AS _e{i}_{j}") for i, mine in enumerate(ends) for j, sql in enumerate(mine)]
    found = _summaries(rows, len(cols), probs, by, accuracy)
    summaries = durable(found.select(*[c(b).alias(f"_by{j}") for j, b in enumerate(by)], *named), "summaries")
    joined = rows.join(summaries, [c(b).eqNullSafe(c(f"_by{j}")) for j, b in enumerate(by)])
    places = [[f"_e{i}_{j}" for j in range(len(mine))] for i, mine in enumerate(ends)]
    found = _ranked_cells(joined, places, probs, by)
    name = F.element_at(F.array(*[F.lit(n) for n in cols]), c("_i") + 1).alias("column")
    found = durable(found.select(*[c(b) for b in by], name, "n", "q"), "quantiles")
    keys = [*by, "column"]
    missed = F.exists("q", lambda x: x.isNull())
    if not found.filter(missed).isEmpty():
        kept = found.filter(~missed)
        settled = kept.select(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        again = value_quantiles(df, cols, probs, by).join(settled, [c(k).eqNullSafe(c(f"_k{i}")) for i, k in enumerate(keys)], "left_anti")
        found = durable(kept.unionByName(again), "quantiles")
    # Columns of a group without any value.
    every = summaries.select(*[c(f"_by{j}").alias(b) for j, b in enumerate(by)], F.explode(F.array(*[F.lit(n) for n in cols])).alias("column"))
    levels = found.select(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)], "n", "q")
    out = every.join(levels, [c(k).eqNullSafe(c(f"_k{i}")) for i, k in enumerate(keys)], "left")
    return out.select(*[c(k) for k in keys], F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "q")


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    small_rows: int | None = None,
) -> DataFrame:
    """Long table (by..., column, n, q): ``q`` is the array of quantiles in the order of ``probs``, null without values.

    Every group has a row for every column. Null and NaN are missing. ``accuracy`` sets the width of the brackets, and
    with it how much is counted value by value; the result is exact whatever it is.
    """
    ddl = ", ".join(
        [*[f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by], "column string", "n bigint", "q array<double>"]
    )
    if not cols:
        return df.sparkSession.createDataFrame([], ddl)
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    rising = [float(probs[i]) for i in order]
    back = [order.index(i) for i in range(len(probs))]
    small_rows = 4 * accuracy if small_rows is None else small_rows
    rows = df.select(*[c(b) for b in by], *[_clean(n).alias(f"_x{i}") for i, n in enumerate(cols)])
    if not by:
        found = _of_table(df, rows, cols, rising, accuracy, small_rows)
        table = []
        for name in cols:
            n, levels = found.get(name, (0, None))
            table.append((name, n, [levels[i] for i in back] if levels else None))
        return df.sparkSession.createDataFrame(table, ddl)
    out = _of_groups(df, rows, cols, rising, by, accuracy, small_rows)
    levels = F.when(c("q").isNotNull(), F.array(*[c("q")[i] for i in back])).alias("q")
    return out.select(*[c(b) for b in by], "column", "n", levels)


def value_histogram(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, cnt) over all non-null values; partial aggregation folds hot values."""
    cells = F.array(*[F.struct(F.lit(n).alias("column"), _clean(n).alias("value")) for n in cols])
    long = df.select(*[c(b) for b in by], F.inline(cells)).filter("value is not null")
    return long.groupBy(*[c(b) for b in by], "column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def value_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, n, q) from counts of all distinct values, ordered across the cluster."""
    groups = [*by, "column"]
    joined = running_totals(value_histogram(df, cols, by), ["value"], {"upto": c("cnt")}, by=groups, grand={"upto": "n"})
    cells = joined.select(*[c(g) for g in groups], "n", c("value").alias("_v"), F.lit(0).alias("_gap"), "cnt", "upto")
    return _interpolated(cells, groups, probs)


def quantile_map(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """{(column, prob): value} on the driver: one number per column and probability."""
    out: dict[tuple[str, float], float | None] = {(n, p): None for n in cols for p in probs}
    for row in quantiles(df, cols, probs).collect():
        for p, value in zip(probs, row["q"] or [], strict=False):
            out[row["column"], p] = value
    return out
