"""Quality checks, reconciliation rule, tracker latest status."""

from __future__ import annotations

import datetime as dt

from treatment_lake.operators.quality import (check_all_orphans, check_lengths, check_not_null, check_orphans,
                                              check_unique)
from treatment_lake.operators.tracker import Tracker, latest_status, reconcile
from treatment_lake.schemas import TRACKER_SCHEMA

from .conftest import rows


def test_checks(spark):
    df = spark.createDataFrame([(1, "ab"), (1, None), (2, "abcdef"), (None, "x")], "k long, s string")
    assert rows(check_unique(df, ["k"])) == [(1, 2)]
    assert dict(rows(check_not_null(df))) == {"k": 1, "s": 1}
    assert rows(check_lengths(df, {"s": 3})) == [("s", 6, 3, 1)]
    parent = spark.createDataFrame([(2,)], "k long")
    # key 1 is orphaned twice; NULL keys are not orphans
    assert rows(check_orphans(df, "k", parent, "k")) == [(1, 2)]


def test_all_orphans_one_pass_per_table(spark, scratch):
    path = scratch("child")
    spark.createDataFrame([(1, 10, 100), (1, 11, None), (2, 10, 101), (3, None, 100)],
                          "a long, b long, c long").write.parquet(path)
    child = spark.read.parquet(path)
    dim_a = spark.createDataFrame([(1,), (2,)], "k long")
    dim_bc = spark.createDataFrame([(10,), (100,)], "k long")
    fks = [("t", "a", "da", "k"), ("t", "b", "dbc", "k"), ("t", "c", "dbc", "k"), ("t", "a", "missing", "k")]
    out = check_all_orphans({"t": child}, {"da": dim_a, "dbc": dim_bc}, fks)
    # a=3, b=11 and c=101 have no parent; NULL keys are never orphans; a FK
    # to an unknown parent is skipped
    assert rows(out) == [("t.a", 3, 1), ("t.b", 11, 1), ("t.c", 101, 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] parquet") == 1  # the child (the only Parquet input) is scanned once


def test_reconcile_rule():
    assert reconcile(5, 5) == "MATCH"
    assert reconcile(5, 4) == "MISMATCH"
    assert reconcile(None, 4) == "SKIPPED" and reconcile(-1, 4) == "SKIPPED" and reconcile(4, -1) == "SKIPPED"


def test_tracker_latest_status(spark, scratch):
    path = scratch("tracker")
    fixed = dt.datetime(2024, 1, 1)
    tr = Tracker(spark, path, "run-1", clock=lambda: fixed)
    tr.started("dim_dates", "silver", "gold", "silver", "dim_dates")
    tr.finished("dim_dates", "silver", "gold", "silver", "dim_dates", 10, 10)
    tr.started("fact", "silver", "gold", "silver", "fact")
    tr.failed("fact", "silver", "gold", "silver", "fact")
    t = spark.read.schema(TRACKER_SCHEMA).parquet(path)
    assert t.count() == 4
    got = {r["step"]: (r["status"], r["reconciliation_status"]) for r in latest_status(t).collect()}
    assert got == {"dim_dates": ("SUCCESS", "MATCH"), "fact": ("FAILED", None)}


def test_session_keeps_cluster_settings(spark):
    """Without arguments ``build_session`` neither forces a master nor resets the
    shuffle partition count of the session it joins."""
    from treatment_lake.session import build_session

    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    s = build_session()
    assert (s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions")) == before
