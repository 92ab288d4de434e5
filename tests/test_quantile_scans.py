"""Quantiles take two scans, whatever the columns, groups and levels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trendspark.operators import quantiles
from trendspark.session import durable


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(31)
    n = 50_000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "h": rng.integers(0, 2, n), "a": rng.normal(size=n), "b": rng.integers(0, 9, n), "c": np.where(rng.random(n) < 0.4, 1.5, rng.random(n))})
    pdf.loc[::50, "a"] = np.nan
    pdf.loc[pdf["g"] == 2, "c"] = np.nan
    return durable(spark.createDataFrame(pdf), "table"), pdf


PROBS = [0.9, 0.1, 0.5, 0.25]


def test_whole_table_in_two_actions(table, monkeypatch):
    df, pdf = table
    calls = []
    for name in ("first", "collect"):
        monkeypatch.setattr(type(df), name, lambda self, *a, _n=name, _r=getattr(type(df), name): (calls.append(_n), _r(self, *a))[1])
    found = {(r.column, r.n): r.q for r in quantiles.quantiles(df, ["a", "b", "c"], PROBS, accuracy=500).toLocalIterator()}
    assert calls.count("first") == 1 and calls.count("collect") <= 2  # first() collects once itself
    for name in "abc":
        known = pdf[name].dropna()
        assert found[name, len(known)] == pytest.approx(np.quantile(known, PROBS).tolist(), rel=1e-12)


def test_groups_in_two_written_tables(table, monkeypatch):
    df, pdf = table
    written = []
    monkeypatch.setattr(quantiles, "durable", lambda d, name="table": (written.append((name, d)), durable(d, name))[1])
    rows = quantiles.quantiles(df, ["a", "b", "c"], PROBS, by=["g", "h"], accuracy=100).collect()
    assert [name for name, _ in written] == ["summaries", "quantiles"]
    # The table alone, then the table with the summaries.
    assert [d._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for _, d in written] == [1, 2]
    assert len(rows) == 18
    for r in rows:
        known = pdf.loc[(pdf["g"] == r["g"]) & (pdf["h"] == r["h"]), r["column"]].dropna()
        assert r["n"] == len(known)
        if r["column"] == "c" and r["g"] == 2:
            assert r["q"] is None
        else:
            assert r["q"] == pytest.approx(np.quantile(known, PROBS).tolist(), rel=1e-12)


def test_what_is_counted_by_value_is_a_small_share(table):
    """The cells of a narrow bracket are few: values inside brackets, and gaps between them."""
    df, _ = table
    rows = df.select(F.col("a").alias("_x0"))
    first = quantiles._summaries(rows.filter(~F.isnan("_x0")), 1, [0.5], (), 1000).first()
    ends = [[quantiles._double(x) for x in first["s0"]]]
    assert first["s0"][0] < first["s0"][1]
    inside = rows.filter(F.col("_x0").between(*first["s0"])).count()
    assert inside <= 0.01 * first["n0"]
    found = quantiles._ranked_cells(rows.filter(~F.isnan("_x0")), ends, [0.5], ()).first()
    assert found["n"] == first["n0"] and found["q"][0] is not None
