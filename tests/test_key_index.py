"""Key indexes of ingested batches: which folders a new batch opens."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.session import scratch_path
from trendspark.streaming import ingest
from trendspark.streaming.ingest import incremental_ingest, read_sink

SCHEMA = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType())])


def write_batch(spark, sink, number, keys):
    df = spark.createDataFrame([(k, 1) for k in keys], SCHEMA)
    df.write.mode("overwrite").parquet(f"{sink}/batch={number}")
    ingest.write_key_index(spark, sink, f"batch={number}", "key", T.LongType())


def opened(spark, sink, folders, keys, kind="bigint"):
    df = spark.createDataFrame([(k,) for k in keys], f"key {kind}")
    return set(ingest.folders_to_open(spark, sink, folders, df, "key"))


def test_ranges_and_filters_choose_the_folders(spark):
    sink = scratch_path(spark, "sink")
    write_batch(spark, sink, 0, range(0, 1000))
    write_batch(spark, sink, 1, range(2000, 3000))
    write_batch(spark, sink, 2, range(0, 4000, 1000))
    write_batch(spark, sink, 3, [])
    folders = [f"batch={i}" for i in range(4)]
    assert opened(spark, sink, folders, [5000]) == set()
    assert opened(spark, sink, folders, [2500]) == {"batch=1"}  # inside the range of batch 2, not in its filter
    assert opened(spark, sink, folders, [2000, 5]) == {"batch=0", "batch=1", "batch=2"}
    assert opened(spark, sink, folders, []) == set()
    # A folder without an index is opened.
    spark.createDataFrame([(9, 1)], SCHEMA).write.parquet(f"{sink}/batch=4")
    assert opened(spark, sink, [*folders, "batch=4"], [5000]) == {"batch=4"}


def test_filters_lose_no_key_and_pass_few_others(spark):
    sink = scratch_path(spark, "sink")
    write_batch(spark, sink, 0, range(0, 40_000, 2))
    held = spark.range(0, 40_000, 2).withColumnRenamed("id", "key")
    for k in (0, 18_764, 39_998):
        assert ingest.folders_to_open(spark, sink, ["batch=0"], held.filter(F.col("key") == k), "key") == ["batch=0"]
    passed = sum(bool(ingest.folders_to_open(spark, sink, ["batch=0"], held.limit(0).union(spark.createDataFrame([(k,)], "key bigint")), "key")) for k in range(1, 80, 4))
    assert passed <= 2


@pytest.mark.parametrize(("name", "value"), [("FILTER_KEYS", 10), ("SENT_BYTES", 10)])
def test_batches_without_a_filter_are_opened_by_range(spark, monkeypatch, name, value):
    monkeypatch.setattr(ingest, name, value)
    sink = scratch_path(spark, "sink")
    write_batch(spark, sink, 0, range(0, 1000, 2))
    assert opened(spark, sink, ["batch=0"], [501]) == {"batch=0"}
    assert opened(spark, sink, ["batch=0"], [-7]) == set()


def test_text_keys(spark):
    sink = scratch_path(spark, "sink")
    spark.createDataFrame([("b", 1), ("ü", 2)], "key string, n int").write.parquet(f"{sink}/batch=0")
    ingest.write_key_index(spark, sink, "batch=0", "key", T.StringType())
    assert opened(spark, sink, ["batch=0"], ["ü"], "string") == {"batch=0"}
    assert opened(spark, sink, ["batch=0"], ["c"], "string") == set()


def test_later_batches_open_few_folders_and_replays_are_safe(spark, monkeypatch):
    home = scratch_path(spark, "ingest")
    calls = []
    real = ingest.folders_to_open
    monkeypatch.setattr(ingest, "folders_to_open", lambda s, sink, folders, keys, key: (calls.append((len(folders), got := real(s, sink, folders, keys, key))), got)[1])

    def run(state):
        return {tuple(r) for r in incremental_ingest(spark, f"{home}/in", f"{home}/out", f"{home}/{state}", SCHEMA, "key", ["n"], files_per_batch=1).collect()}

    want = set()
    for i in range(6):
        # Rising keys; each batch repeats one key of the one before.
        data = [(10 * i + k, i) for k in range(-1 if i else 0, 10)]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(f"{home}/in")
        want |= {(k, i) for k, i in data if k >= 10 * i}
        assert run("state") == want
    assert [n for n, _ in calls] == list(range(1, 6))
    assert all(len(got) <= 2 for _, got in calls) and sum(len(got) for _, got in calls) <= 7
    # The same files again from the start: every batch replaces its folder.
    assert {k for k, _ in run("other state")} == {k for k, _ in want}
    assert read_sink(spark, f"{home}/out", SCHEMA).groupBy("key").count().filter("count > 1").count() == 0
