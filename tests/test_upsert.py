"""Latest-per-key, upserts, run tables, idempotence."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from treatment_lake.operators.dedupe import latest_per_key
from treatment_lake.operators.upsert import RunTable, insert_new_only, upsert_type1

from .conftest import rows

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SCHEMA = "k long, v string, ts timestamp_ntz"


def test_latest_per_key_ties_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", D1), (1, "b", D2), (2, "x", D2), (2, "y", D2), (3, "n", None), (3, "m", D1),
         (None, "z", D2)], SCHEMA)
    got = rows(latest_per_key(df, ["k"], ["ts"]))
    # newest wins; a tie is broken by the other columns (largest); NULL ts loses; NULL key dropped
    assert got == [(1, "b", D2), (2, "y", D2), (3, "m", D1)]


def test_latest_per_key_hot_key_is_pre_aggregated(spark):
    hot = spark.range(0, 20000).selectExpr("1L AS k", "CAST(id AS STRING) AS v",
                                           "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts")
    out = latest_per_key(hot, ["k"], ["ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a partial (map-side) aggregate runs before the shuffle on the key
    assert plan.count("Aggregate") >= 2
    assert out.count() == 1 and out.first()["v"] == "9999"


def test_upsert_type1_and_insert_only(spark):
    tgt = spark.createDataFrame([(1, "old", D1), (2, "keep", D1)], SCHEMA)
    src = spark.createDataFrame([(1, "new", D2), (3, "ins", D2), (None, "nullkey", D2)], SCHEMA)
    assert rows(upsert_type1(tgt, src, ["k"])) == [(1, "new", D2), (2, "keep", D1), (3, "ins", D2)]
    assert rows(insert_new_only(tgt, src, ["k"])) == [(1, "old", D1), (2, "keep", D1), (3, "ins", D2)]


def test_upsert_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, "old", D1)], SCHEMA)
    src = spark.createDataFrame([(1, "new", D2), (3, "ins", D2)], SCHEMA)
    once = upsert_type1(tgt, src, ["k"])
    twice = upsert_type1(once, src, ["k"])
    assert rows(once) == rows(twice)


KV = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def test_run_table_replaces_fails_and_retries(spark, scratch):
    root = scratch("rt")
    t = RunTable(spark, root, KV, keep_minutes=0)
    assert not t.exists() and t.read().count() == 0
    t.replace(spark.createDataFrame([(1, "a")], KV))
    # a failing write leaves the table as it was, and the next write goes through
    bad = spark.createDataFrame([(1, "x")], KV).selectExpr("k", "CAST(assert_true(k < 0) AS STRING) AS v")
    for _ in range(2):
        with pytest.raises(Exception):
            t.replace(bad)
        assert rows(t.read()) == [(1, "a")]
    for v in ("b", "c", "d"):
        t.replace(spark.createDataFrame([(1, v)], KV))
        assert rows(RunTable(spark, root, KV).read()) == [(1, v)]
    # old folders and failed writes are gone; with the default they would stay for readers
    assert len(os.listdir(f"{root}/runs")) == 1 and len([n for n in os.listdir(f"{root}/pointer") if n.endswith(".json")]) == 2


def test_run_table_keeps_folders_of_readers_and_refuses_a_second_writer(spark, scratch):
    root = scratch("rt")
    t = RunTable(spark, root, KV)
    t.replace(spark.createDataFrame([(1, "a")], KV))
    reader = t.read()
    t.replace(spark.createDataFrame([(1, "b")], KV))
    assert rows(reader) == [(1, "a")] and rows(t.read()) == [(1, "b")]
    with pytest.raises(RuntimeError, match="another writer"):
        t._commit("other", 2)
    with open(f"{root}/pointer/0000000003.json", "w"):  # a pointer whose content is not there yet
        pass
    assert rows(t.read()) == [(1, "b")]
