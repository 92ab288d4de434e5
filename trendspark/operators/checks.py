"""Statistical and cross-column checks.

Each returns rows (dimension, check, column, passed, issue_count, detail); the
``*_probes`` forms can be fused into one scan with ``probes.evaluate``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions.numbers import known_number
from trendspark.functions.text import is_blank, literal_list_length, normalize_language
from trendspark.functions.times import as_timestamp
from trendspark.operators import aggregates
from trendspark.operators.distribution import fences, pearson, spearman
from trendspark.operators.filters import video_rules
from trendspark.operators.joins import keep_members
from trendspark.operators.projection import is_numeric, names_by_rule
from trendspark.operators.probes import Probe, evaluate, fixed_rows, no_detail, zero_count
from trendspark.operators.quantiles import quantile_map
from trendspark.session import c


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in cols if n in have]


def check_schema(df: DataFrame, columns: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """Missing columns and wrong types fail; extra columns are reported only. ``types`` are Spark type names."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows: list[tuple] = [("Consistency", "schema", n, False, 1, "missing") for n in columns if n not in have]
    rows += [("Consistency", "schema", n, True, 1, "extra") for n in have if n not in set(columns)]
    for name, wanted in types.items():
        if name in have and have[name] != wanted:
            rows.append(("Consistency", "schema", name, False, 1, f"expected {wanted}, got {have[name]}"))
    return fixed_rows(df, rows or [("Consistency", "schema", "table", True, 0, None)])


def check_language(df: DataFrame, col: str, codes: DataFrame, samples: int = 5) -> DataFrame:
    """Values whose base code is unknown, with the first few in order."""
    if col not in df.columns:
        return fixed_rows(df, [("Consistency", "language", col, False, 0, "column not found")])
    values = df.select(c(col).alias("value")).filter("value is not null").groupBy("value").count()
    bad = keep_members(values.withColumn("code", normalize_language(c("value"))), "code", codes, keep=False)
    listed = bad.orderBy("value").limit(samples).agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("s"))
    total = bad.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    return total.select(
        F.lit("Consistency").alias("dimension"),
        F.lit("language").alias("check"),
        F.lit(col).alias("column"),
        (c("n") == 0).alias("passed"),
        c("n").cast("bigint").alias("issue_count"),
        listed.scalar().alias("detail"),
    )


def blank_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, blanks): non-null values holding only white space."""
    names = _present(df, cols)
    wide = df.agg(*[F.count_if(is_blank(c(n).cast("string"))).alias(f"b{i}") for i, n in enumerate(names)])
    cells = [F.struct(F.lit(n).alias("column"), c(f"b{i}").alias("blanks")) for i, n in enumerate(names)]
    return wide.select(F.inline(F.array(*cells)))


def blank_probes(df: DataFrame, cols: Sequence[str]) -> list[Probe]:
    return [zero_count("Completeness", "blank_strings", n, is_blank(c(n).cast("string"))) for n in _present(df, cols)]


def check_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return evaluate(df, blank_probes(df, cols))


def cross_column_probes(df: DataFrame, strict_types: bool = False) -> list[Probe]:
    rules = video_rules(df, strict_types)
    return [zero_count("Accuracy", "cross_column", name, broken) for name, broken in rules.items()]


def check_cross_column(df: DataFrame, strict_types: bool = False) -> DataFrame:
    return evaluate(df, cross_column_probes(df, strict_types))


def _moment(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; only text is parsed."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c(name).cast("timestamp")
    return as_timestamp(c(name))


def future_probes(df: DataFrame, cols: Sequence[str], now: datetime) -> list[Probe]:
    return [zero_count("Timeliness", "no_future_dates", n, _moment(df, n) > F.lit(now)) for n in _present(df, cols)]


def future_counts(df: DataFrame, cols: Sequence[str], now: datetime) -> DataFrame:
    """(column, future): timestamps after ``now``."""
    return evaluate(df, future_probes(df, cols, now)).select("column", c("issue_count").alias("future"))


def check_future(df: DataFrame, cols: Sequence[str], now: datetime) -> DataFrame:
    return evaluate(df, future_probes(df, cols, now))


def _dates(df: DataFrame, earlier: str, later: str) -> tuple[Column, Column]:
    return F.to_date(_moment(df, earlier)), F.to_date(_moment(df, later))


def date_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """One row: reversed pairs, rows skipped for a missing date, non-null values that are no date."""
    a, b = _dates(df, earlier, later)
    return df.agg(
        F.count_if(b < a).alias("reversed"),
        F.count_if(a.isNull() | b.isNull()).alias("skipped"),
        (F.count_if(c(earlier).isNotNull() & a.isNull()) + F.count_if(c(later).isNotNull() & b.isNull())).alias(
            "unparseable"
        ),
    )


def date_order_probes(df: DataFrame, earlier: str, later: str) -> list[Probe]:
    a, b = _dates(df, earlier, later)
    bad = F.count_if(c(earlier).isNotNull() & a.isNull()) + F.count_if(c(later).isNotNull() & b.isNull())
    skipped = F.count_if(a.isNull() | b.isNull())

    def verdict(r: Sequence[Column]) -> tuple[Column, Column, Column]:
        return r[0] == 0, r[0], F.concat(F.lit("skipped="), r[1], F.lit(", unparseable="), r[2])

    return [Probe("Timeliness", "date_order", f"{earlier},{later}", [F.count_if(b < a), skipped, bad], verdict)]


def check_date_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """An absent column is an issue but passes."""
    if len(_present(df, [earlier, later])) < 2:
        return fixed_rows(df, [("Timeliness", "date_order", f"{earlier},{later}", True, 0, "column not found")])
    return evaluate(df, date_order_probes(df, earlier, later))


def iqr_probes(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> list[Probe]:
    names = _present(df, cols)
    q = quantile_map(df, names, [0.25, 0.75])
    probes = []
    for n in names:
        q1, q3 = q[n, 0.25], q[n, 0.75]
        if q1 is None or q3 == q1:
            note = "no values" if q1 is None else "IQR=0, skipped"
            probes.append(
                Probe("Outliers", "outliers_iqr", n, [F.count(F.lit(1))], lambda r, s=note: (F.lit(True), F.lit(0), F.lit(s)))
            )
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        probes.append(zero_count("Outliers", "outliers_iqr", n, (known_number(n) < lo) | (known_number(n) > hi)))
    return probes


def check_outliers_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    return evaluate(df, iqr_probes(df, cols, k))


def zscore_probes(df: DataFrame, cols: Sequence[str], threshold: float = 5.0) -> list[Probe]:
    bounds = fences(df, _present(df, cols), "zscore", z=threshold)
    # Equal fences mean no spread, and then no value lies outside them.
    return [
        zero_count("Outliers", "outliers_zscore", n, (known_number(n) < lo) | (known_number(n) > hi) if lo < hi else F.lit(False))
        for n, (lo, hi) in bounds.items()
    ]


def check_outliers_z(df: DataFrame, cols: Sequence[str], threshold: float = 5.0) -> DataFrame:
    return evaluate(df, zscore_probes(df, cols, threshold))


def check_dominance(df: DataFrame, col: str, max_share: float = 0.8) -> DataFrame:
    """The most frequent value must not exceed ``max_share``; an absent column passes."""
    if col not in df.columns:
        return fixed_rows(df, [("Distribution", "dominance", col, True, 0, "column not found")])
    counts = df.filter(c(col).isNotNull()).groupBy(c(col)).agg(F.count(F.lit(1)).alias("n"))
    share = counts.agg(F.try_divide(F.max("n").cast("double"), F.sum("n").cast("double")).alias("s"))
    high = F.coalesce(c("s") > max_share, F.lit(False))
    return share.select(
        F.lit("Distribution").alias("dimension"),
        F.lit("dominance").alias("check"),
        F.lit(col).alias("column"),
        (~high).alias("passed"),
        F.when(high, 1).otherwise(0).cast("bigint").alias("issue_count"),
        F.format_string("top_share=%.4f", c("s")).alias("detail"),
    )


def variance_probes(df: DataFrame, cols: Sequence[str]) -> list[Probe]:
    def verdict(r: Sequence[Column]) -> tuple[Column, Column, Column]:
        constant = F.coalesce(r[0] == 0, F.lit(False))
        return ~constant, F.when(constant, 1).otherwise(0), no_detail()

    return [
        Probe("Distribution", "variance", n, [F.stddev_samp(known_number(n))], verdict) for n in _present(df, cols)
    ]


def check_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return evaluate(df, variance_probes(df, cols))


def imbalance_probes(df: DataFrame, col: str, threshold: float = 0.9) -> list[Probe]:
    known = c(col).isNotNull()

    def verdict(r: Sequence[Column]) -> tuple[Column, Column, Column]:
        zeros, ones, others = r
        share = F.try_divide(F.greatest(zeros, ones).cast("double"), (zeros + ones).cast("double"))
        bad = (others > 0) | F.coalesce(share > threshold, F.lit(False))
        return (
            ~bad,
            F.when(others > 0, others).otherwise(F.when(bad, 1).otherwise(0)),
            F.when(others > 0, F.lit("non-binary values")).otherwise(F.format_string("dominant_share=%.4f", share)),
        )

    aggs = [F.count_if(c(col) == 0), F.count_if(c(col) == 1), F.count_if(known & ~c(col).isin(0, 1))]
    return [Probe("Distribution", "class_imbalance", col, aggs, verdict)]


def check_imbalance(df: DataFrame, col: str, threshold: float = 0.9) -> DataFrame:
    if col not in df.columns:
        return fixed_rows(df, [("Distribution", "class_imbalance", col, True, 0, "column not found")])
    return evaluate(df, imbalance_probes(df, col, threshold))


def check_correlation(df: DataFrame, cols: Sequence[str], threshold: float = 0.7, method: str = "pearson") -> DataFrame:
    """Pairs with |r| above the threshold fail."""
    names = _present(df, cols)
    if len(names) < 2:
        return fixed_rows(df, [])
    pairs = pearson(df, names) if method == "pearson" else spearman(df, names)
    high = F.coalesce((~F.isnan("r")) & (F.abs(c("r")) > threshold), F.lit(False))
    return pairs.select(
        F.lit("Relationships").alias("dimension"),
        F.lit(f"correlation_{method}").alias("check"),
        F.concat_ws(",", "a", "b").alias("column"),
        (~high).alias("passed"),
        F.when(high, 1).otherwise(0).cast("bigint").alias("issue_count"),
        F.format_string("r=%.2f", c("r")).alias("detail"),
    )


def skew_probes(df: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> list[Probe]:
    def verdict(r: Sequence[Column]) -> tuple[Column, Column, Column]:
        n = r[1].cast("double")
        value = F.when(n > 2, r[0] * F.sqrt(n * (n - 1)) / (n - 2))
        high = F.coalesce((~F.isnan(value)) & (F.abs(value) > threshold), F.lit(False))
        return ~high, F.when(high, 1).otherwise(0), F.format_string("skew=%.2f", value)

    return [
        Probe("Relationships", "skew", n, [F.skewness(c(n).cast("double")), F.count(c(n))], verdict)
        for n in _present(df, cols)
    ]


def check_skew(df: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> DataFrame:
    return evaluate(df, skew_probes(df, cols, threshold))


def count_match_probes(df: DataFrame, count_col: str, list_col: str) -> list[Probe]:
    found = literal_list_length(c(list_col))
    declared = F.coalesce(c(count_col).cast("double").cast("bigint"), F.lit(0))

    def verdict(r: Sequence[Column]) -> tuple[Column, Column, Column]:
        bad, mismatch = r
        return (bad == 0) & (mismatch == 0), bad + mismatch, F.concat(F.lit("unparseable="), bad, F.lit(", mismatch="), mismatch)

    aggs = [F.count_if(found == -1), F.count_if((found >= 0) & (declared != found))]
    return [Probe("Referential Integrity", "count_matches", f"{count_col},{list_col}", aggs, verdict)]


def check_count_matches(df: DataFrame, count_col: str, list_col: str) -> DataFrame:
    if len(_present(df, [count_col, list_col])) < 2:
        return fixed_rows(df, [("Referential Integrity", "count_matches", f"{count_col},{list_col}", True, 0, "column not found")])
    return evaluate(df, count_match_probes(df, count_col, list_col))


def run_checks(
    df: DataFrame,
    numeric: Sequence[str],
    text: Sequence[str],
    dates: Sequence[str],
    now: datetime,
    codes: DataFrame | None = None,
    target: str = "is_trending",
    category: str = "categoryId",
    k: float = 1.5,
    z: float = 3.0,
    corr: float = 0.6,
    skew: float = 0.6,
    list_counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """All checks of a table; everything that is a plain aggregate shares one scan."""
    probes = [*blank_probes(df, text), *cross_column_probes(df), *future_probes(df, dates, now)]
    if len(dates) >= 2 and len(_present(df, dates[:2])) == 2:
        probes += date_order_probes(df, dates[0], dates[1])
    probes += [*iqr_probes(df, numeric, k), *zscore_probes(df, numeric, z)]
    probes += [*variance_probes(df, numeric), *skew_probes(df, numeric, skew)]
    if target in df.columns:
        probes += imbalance_probes(df, target)
    for count_col, list_col in (list_counts or {}).items():
        if len(_present(df, [count_col, list_col])) == 2:
            probes += count_match_probes(df, count_col, list_col)
    out = evaluate(df, probes)
    out = out.unionByName(check_dominance(df, category))
    out = out.unionByName(check_correlation(df, numeric, corr, "pearson"))
    out = out.unionByName(check_correlation(df, numeric, corr, "spearman"))
    if codes is not None and "defaultLanguage" in df.columns:
        out = out.unionByName(check_language(df, "defaultLanguage", codes))
    return out


def scorecard(checks: DataFrame) -> DataFrame:
    """Passed and total checks per dimension and overall; a check passes when all its rows do."""
    folded = checks.groupBy("dimension", "check").agg(F.every("passed").alias("ok"))
    table = folded.rollup("dimension").agg(F.count_if("ok").alias("passed"), F.count(F.lit(1)).alias("total"))
    return table.select(
        F.coalesce("dimension", F.lit("TOTAL")).alias("dimension"),
        "passed",
        "total",
        (c("passed") / c("total") * 100).alias("success_pct"),
    )


def quick_summary(df: DataFrame, target: str, top_nulls: int | None = None, numeric_cols: int | None = None) -> DataFrame:
    """Shape, target distribution, null counts and numeric ranges as (section, name, metric, value).

    All columns are reported; ``top_nulls`` and ``numeric_cols`` shorten a printed page.
    """

    def lines(frame: DataFrame, section: str, name: Column, metrics: Mapping[str, Column]) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()]
        return frame.select(F.lit(section).alias("section"), name.cast("string").alias("name"), F.inline(F.array(*cells)))

    shape = aggregates.row_col_counts(df)
    out = lines(shape, "shape", F.lit("table"), {"rows": c("n_rows"), "columns": c("n_cols")})
    if target in df.columns:
        shares = aggregates.value_shares(df, target, keep_null=True)
        out = out.unionByName(
            lines(shares, "target", F.coalesce(c("value").cast("string"), F.lit("null")), {"rows": c("n"), "pct": c("share") * 100})
        )
    out = out.unionByName(lines(aggregates.null_counts(df, top_nulls), "nulls", c("column"), {"nulls": c("nulls")}))
    names = names_by_rule(df, is_numeric)[:numeric_cols]
    aggs = [e for i, n in enumerate(names) for e in (F.avg(known_number(n)).alias(f"a{i}"), F.min(known_number(n)).alias(f"b{i}"), F.max(known_number(n)).alias(f"c{i}"))]
    cells = [
        F.struct(F.lit(n).alias("name"), c(f"a{i}").cast("double").alias("mean"), c(f"b{i}").cast("double").alias("min"), c(f"c{i}").cast("double").alias("max"))
        for i, n in enumerate(names)
    ]
    numeric = df.agg(*aggs).select(F.inline(F.array(*cells)))
    return out.unionByName(lines(numeric, "numeric", c("name"), {"mean": c("mean"), "min": c("min"), "max": c("max")}))
