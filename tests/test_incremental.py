"""Watermarks, load mode, incremental filters, and split invariance of the
source -> bronze -> silver -> gold build."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from treatment_lake.operators.ledger import Ledger
from treatment_lake.operators.tracker import Tracker
from treatment_lake.plans.end_to_end import Layout, mart, run_once, tracker_table
from treatment_lake.plans.gold import gold_tables
from treatment_lake.plans.registry import flat_snapshot
from treatment_lake.plans.silver_build import (bronze_to_silver, extract_to_bronze, ledger, read_silver, reset_layer,
                                               silver_from_pending)
from treatment_lake.sources import layers
from treatment_lake.sources.items import write_items

from .conftest import SMOKE_DIR, rows


def test_incremental_filter_and_lookback(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 10)), (2, dt.datetime(2024, 1, 1, 11)), (3, dt.datetime(2024, 1, 1, 12))],
        "k long, metadata_modified_at timestamp_ntz")
    wm = layers.watermark_value(df.where("k < 3"))
    assert wm == dt.datetime(2024, 1, 1, 11)
    assert [r.k for r in layers.incremental_filter(df, wm).collect()] == [3]
    assert sorted(r.k for r in layers.incremental_filter(df, wm, lookback="1 HOUR").collect()) == [1, 2, 3]
    assert sorted(r.k for r in layers.rows_at_watermark(df).collect()) == [3]


def test_filter_reaches_parquet_scan(spark):
    from treatment_lake.sources.tables import read_table

    ev = read_table(spark, SMOKE_DIR, "events")
    plan = layers.incremental_filter(ev, "2024-01-15 00:00:00", None, "ts") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_load_mode(spark, scratch):
    assert layers.load_mode(spark, scratch("nothing")) == "full"


CLOCK = lambda: dt.datetime(2100, 1, 1)


def early():
    return F.col("metadata_modified_at") <= F.lit("1996-01-01").cast("timestamp_ntz")


def _export(spark, scratch, rows_):
    path = scratch("items")
    write_items(rows_, path)
    return path


def test_split_invariance(spark, scratch):
    """One run == the same records in two runs: gold, marts (success included) and counts."""
    flat = flat_snapshot(spark, SMOKE_DIR)

    def run(batches):
        layout = Layout(scratch("lake"))
        for i, cond in enumerate(batches):
            run_once(spark, _export(spark, scratch, flat.where(cond)), layout, f"r{i}", clock=CLOCK)
        return layout, gold_tables(spark, layout.gold)

    l1, g1 = run([F.lit(True)])
    l3, g3 = run([early(), F.lit(True)])
    for name in ("fact_treatments", "dim_providers", "dim_dates", "dim_locations", "dim_patients"):
        a, b = g1[name].read(), g3[name].read()
        if name == "fact_treatments":  # ids are given in the order of arrival
            a, b = a.drop("treatment_type_and_outcome_status_sk"), b.drop("treatment_type_and_outcome_status_sk")
        assert rows(a) == rows(b), name
    for name in ("provider_success_rate_rank", "monthly_treatment_trends", "summary_avg_treatment_cost"):
        assert rows(mart(spark, l1, name)) == rows(mart(spark, l3, name)), name
    steps = tracker_table(spark, l3).where("status = 'SUCCESS'")
    assert {r["reconciliation_status"] for r in steps.collect()} == {"MATCH"}


def test_items_without_a_time_are_never_lost(spark, scratch):
    flat = flat_snapshot(spark, SMOKE_DIR)
    unknown = F.col("treatment_id") % 7 == 0
    mixed = flat.withColumn("metadata_modified_at", F.when(~unknown, F.col("metadata_modified_at")))
    bronze, silver = scratch("bronze"), scratch("silver")
    extract_to_bronze(spark, _export(spark, scratch, mixed.where(early() & ~unknown)), bronze, "r1", clock=CLOCK)
    extract_to_bronze(spark, _export(spark, scratch, mixed), bronze, "r2", clock=CLOCK)
    silver_from_pending(spark, bronze, silver)
    assert read_silver(spark, silver).select("treatment_id").distinct().count() == flat.count()


def test_crash_between_layers_is_taken_up(spark, scratch):
    flat = flat_snapshot(spark, SMOKE_DIR)
    bronze, silver = scratch("bronze"), scratch("silver")
    extract_to_bronze(spark, _export(spark, scratch, flat), bronze, "r1", clock=CLOCK)
    extract_to_bronze(spark, _export(spark, scratch, flat), bronze, "r2", clock=CLOCK)  # nothing new
    gold = Ledger(spark, f"{scratch('gold')}_meta/ledger")
    assert [r["run_id"] for r in silver_from_pending(spark, bronze, silver)] == ["r1", "r2"]
    assert read_silver(spark, silver).count() == flat.count() and silver_from_pending(spark, bronze, silver) == []
    assert gold.missing(ledger(spark, silver)) == ["r1", "r2"]
    gold.commit("r1", 0)
    assert gold.missing(ledger(spark, silver)) == ["r2"]
    # a run written again replaces itself
    bronze_to_silver(spark, bronze, silver, "r1")
    assert read_silver(spark, silver).count() == flat.count()
    # a started step leaves its row even if it never ends
    tracker = Tracker(spark, scratch("tracker"), "run")
    tracker.started("extract", "source", "bronze", "a", "b")
    assert [r["status"] for r in spark.read.parquet(tracker.path).collect()] == ["STARTED"]


def test_empty_and_missing_export_and_reset(spark, scratch):
    bronze = scratch("bronze")
    assert extract_to_bronze(spark, scratch("none"), bronze)["rows"] == 0
    run = extract_to_bronze(spark, _export(spark, scratch, flat_snapshot(spark, SMOKE_DIR)), bronze)
    assert run["rows"] > 0
    reset_layer(spark, bronze)
    assert layers.load_mode(spark, bronze) == "full" and ledger(spark, bronze).runs() == []
    assert layers.count_rows(spark, bronze) is None


def test_incremental_silver_reads_only_its_run(spark, scratch):
    """The plan of an incremental read scans the pending run's folder and no other."""
    silver = scratch("silver")
    flat = flat_snapshot(spark, SMOKE_DIR)
    bronze = scratch("bronze")
    for i, cond in enumerate((early(), ~early())):
        extract_to_bronze(spark, _export(spark, scratch, flat.where(cond)), bronze, f"r{i}", clock=CLOCK)
        bronze_to_silver(spark, bronze, silver, f"r{i}")
    one = read_silver(spark, silver, ["r1"])
    assert {f.split("ingest_run_id=")[1].split("/")[0] for f in one.inputFiles()} <= {"r0", "r1"}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_run_id" in plan and one.count() == flat.where(~early()).count()


def test_read_errors_are_not_an_empty_layer(spark, scratch):
    path = scratch("broken")
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        layers.load_mode(spark, path)
