"""Lookups by values that a third of the rows share."""

import pytest
from pyspark.sql import functions as F

from trendspark.operators import distribution, encoding
from trendspark.operators.heavy import split_lookup
from trendspark.session import c, durable


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one value; the others have values of their own, twice each."""
    value = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.floor(F.col("id") / 2))
    return durable(spark.range(60_000).select("id", value.alias("v"), (F.col("id") % 1000).cast("double").alias("w")).repartition(8), "hot")


def shuffled(spark, df):
    """Rows of each partition after the join's shuffle, without broadcast of the light side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_task_gets_the_rows_of_a_frequent_value(spark, hot):
    sizes = encoding.value_counts(hot, ["v"]).withColumn("value", c("value").cast("bigint"))
    often = c("n") >= 0.001 * c("total")
    assert sizes.filter(often).count() == 1
    found = split_lookup(hot, c("v"), sizes.filter(often), sizes.filter(~often), "value", ["n"])
    assert max(shuffled(spark, found)) < 1.5 * 60_000 / 8
    plain = hot.join(sizes.select(c("value").alias("v"), "n"), "v", "left")
    assert max(shuffled(spark, plain)) > 20_000
    assert found.join(plain.select("id", c("n").alias("m")), "id").filter(~c("n").eqNullSafe(c("m"))).count() == 0
    assert found.count() == 60_000


def test_unknown_and_null_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")], "i int, k string")
    heavy = spark.createDataFrame([("a", 1)], "k string, x int")
    light = spark.createDataFrame([("b", 2)], "k string, x int")
    got = {r["i"]: r["x"] for r in split_lookup(rows, c("k"), heavy, light, "k", ["x"]).collect()}
    assert got == {1: 1, 2: 2, 3: None, 4: None, 5: 1}


def test_columns_of_any_name_stay(spark):
    names = ["_key", "_heavy", "_light", "_deal", "_on", "_at", "_share", "_rare", "_lookup_key", "__lookup_on", "value", "n"]
    df = spark.createDataFrame([(i % 3, *range(100 * i, 100 * i + len(names))) for i in range(9)], "v int, " + ", ".join(f"{n} int" for n in names))
    kept = [("v" if n == "v" else n) for n in df.columns]
    for out in (encoding.group_rare_count(df, "v", 4, other=7), encoding.FrequencyEncoding.fit(df, ["v"]).apply(df), distribution.average_rank(df, "v", "r")):
        assert out.columns[: len(kept)] == kept
        assert sorted(out.select(names).collect()) == sorted(df.select(names).collect())


def test_encodings_of_a_hot_value(spark, hot):
    rare = encoding.group_rare_count(hot, "v", 3, other=-9)
    assert {r["v"]: r["count"] for r in rare.groupBy("v").count().collect()} == {-1: 20_000, -9: 40_000}
    shares = encoding.FrequencyEncoding.fit(hot, ["v", "w"]).apply(hot)
    row = shares.agg(F.max("v"), F.min("w"), F.max("w"), F.count("v")).first()
    assert row[0] == pytest.approx(1 / 3) and row[1] == row[2] == 0.001 and row[3] == 60_000


def test_encoding_reads_the_table_once(spark, hot, monkeypatch):
    calls = []
    monkeypatch.setattr(encoding, "durable", lambda df, name="table": (calls.append(df), durable(df, name))[1])
    encoding.FrequencyEncoding.fit(hot, ["id", "v", "w"])
    assert len(calls) == 1
    assert calls[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_zeros_and_types_of_keys(spark):
    df = spark.createDataFrame([(0.0, True, "x"), (-0.0, True, None), (1.5, False, "x"), (None, None, "y")], "a double, b boolean, s string")
    got = encoding.FrequencyEncoding.fit(df, ["a", "b", "s"], missing=0.0).apply(df).collect()
    assert [tuple(round(x, 4) for x in r) for r in got] == [(0.6667, 0.6667, 0.6667), (0.6667, 0.6667, 0.0), (0.3333, 0.3333, 0.6667), (0.0, 0.0, 0.3333)]


def test_ranks_of_a_hot_value(spark, hot):
    pdf = hot.toPandas()
    got = {(r["a"], r["b"]): r["r"] for r in distribution.spearman(hot, ["id", "v", "w"]).collect()}
    want = pdf.corr("spearman")
    assert got == {pair: pytest.approx(want.loc[pair], abs=1e-12) for pair in got} and len(got) == 3
    ranks = distribution.average_rank(hot, "v").toPandas().set_index("id")["avg_rank"]
    assert (ranks.sort_index() == pdf.set_index("id")["v"].rank().sort_index()).all()
