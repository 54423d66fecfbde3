"""Ties, late items, new files only: in batch runs and as a stream."""

from __future__ import annotations

import datetime as dt
import glob

from pyspark.sql import functions as F

from treatment_lake.plans.registry import flat_snapshot
from treatment_lake.plans.silver_build import extract_to_bronze, new_files, read_silver, rejects, silver_from_pending
from treatment_lake.sources import layers
from treatment_lake.sources.items import write_items
from treatment_lake.streaming.arrivals import stream_bronze

from .conftest import SMOKE_DIR, rows

CLOCK = lambda: dt.datetime(2100, 1, 1)
TIE = dt.datetime(1996, 1, 1)


def _tied(spark):
    """T with one time in a third of the rows."""
    flat = flat_snapshot(spark, SMOKE_DIR)
    return flat.withColumn("metadata_modified_at", F.when(F.col("treatment_id") % 3 == 0, F.lit(TIE).cast("timestamp_ntz")).otherwise(F.col("metadata_modified_at")))


def _ids(df):
    return sorted(r[0] for r in df.select("treatment_id").collect())


def test_ties_with_the_watermark_are_loaded_once(spark, scratch):
    flat = _tied(spark)
    upto = F.col("metadata_modified_at") <= F.lit(TIE).cast("timestamp_ntz")
    half = F.col("treatment_id") % 2 == 0
    first, second = scratch("e1"), scratch("e2")
    write_items(flat.where(upto & ((F.col("metadata_modified_at") < F.lit(TIE).cast("timestamp_ntz")) | half)), first)
    write_items(flat, second)
    bronze, silver = scratch("bronze"), scratch("silver")
    one = extract_to_bronze(spark, first, bronze, "r1", clock=CLOCK)
    two = extract_to_bronze(spark, second, bronze, "r2", clock=CLOCK)
    silver_from_pending(spark, bronze, silver)
    tied = flat.where(F.col("metadata_modified_at") == F.lit(TIE).cast("timestamp_ntz"))
    assert one["rows"] + two["rows"] == flat.count() and two["late_rows"] == 0
    assert tied.where(half).count() > 50 and tied.where(~half).count() > 50
    assert _ids(read_silver(spark, silver)) == _ids(flat)  # none lost, none twice


def test_late_items_are_refused_and_counted(spark, scratch):
    flat = _tied(spark)
    missing = F.col("treatment_id") % 10 == 7
    bronze = scratch("bronze")
    first, second = scratch("e1"), scratch("e2")
    write_items(flat.where(~missing), first)
    write_items(flat, second)
    extract_to_bronze(spark, first, bronze, "r1", clock=CLOCK)
    newest = flat.agg(F.max("metadata_modified_at")).first()[0]
    want = flat.where(missing & (F.col("metadata_modified_at") < F.lit(newest))).count()
    run = extract_to_bronze(spark, second, bronze, "r2", clock=CLOCK)
    assert run["late_rows"] == want > 0 and run["older_rows"] > want
    late = rejects(spark, bronze).where("kind = 'late'")
    assert late.count() == want and {int(r["treatment_id"]) % 10 for r in late.collect()} == {7}
    # a lookback that reaches them admits them
    wide = scratch("bronze")
    extract_to_bronze(spark, first, wide, "r1", clock=CLOCK, lookback="9000 DAYS")
    run = extract_to_bronze(spark, second, wide, "r2", clock=CLOCK, lookback="9000 DAYS")
    assert run["late_rows"] == 0 and run["rows"] == flat.where(missing).count()


def test_a_second_run_reads_only_new_files(spark, scratch):
    flat = _tied(spark)
    export, bronze = scratch("export"), scratch("bronze")
    write_items(flat.where("treatment_id % 2 = 0").repartition(3), export, mode="append")
    assert extract_to_bronze(spark, export, bronze, clock=CLOCK)["files"] == 3
    assert extract_to_bronze(spark, export, bronze, clock=CLOCK)["files"] == 0
    write_items(flat.where("treatment_id % 2 = 1").repartition(2), export, mode="append")
    assert new_files(spark, export, bronze).count() == 2
    run = extract_to_bronze(spark, export, bronze, clock=CLOCK)
    assert run["files"] == 2 and extract_to_bronze(spark, export, bronze, clock=CLOCK)["files"] == 0
    assert new_files(spark, export, scratch("other"), modified_after="2100-01-01T00:00:00").count() == 0
    # a run that stopped has read nothing
    lost = scratch("bronze")
    try:
        extract_to_bronze(spark, export, lost, "x", clock=lambda: 1 / 0)
    except Exception:
        pass
    whole = scratch("bronze")
    extract_to_bronze(spark, export, whole, "x", clock=CLOCK)
    assert extract_to_bronze(spark, export, whole, "y", clock=CLOCK)["files"] == 0


def test_stream_of_arrivals(spark, scratch):
    flat = _tied(spark)
    landing, bronze, ckpt, tracker = scratch("landing"), scratch("bronze"), scratch("ckpt"), scratch("tracker")
    upto = F.col("metadata_modified_at") <= F.lit(TIE).cast("timestamp_ntz")
    half = F.col("treatment_id") % 2 == 0
    write_items(flat.where(upto & half), f"{landing}/e1")
    first = stream_bronze(spark, f"{landing}/*", bronze, ckpt, delay="30 days", tracker_path=tracker, timeout_s=300)
    assert sum(b["admitted_items"] for b in first) == flat.where(upto & half).count()
    # everything again, with lines that are no items and items without a time
    write_items(flat, f"{landing}/e2")
    odd = flat.limit(4).withColumn("metadata_modified_at", F.lit(None).cast("timestamp_ntz"))
    write_items(odd, f"{landing}/e3")
    spark.createDataFrame([("{broken",), ("{}",), ("{broken",)], "value string").write.text(f"{landing}/e4")
    second = stream_bronze(spark, f"{landing}/*", bronze, ckpt, delay="30 days", tracker_path=tracker, timeout_s=300)
    newest = flat.where(upto & half).agg(F.max("metadata_modified_at")).first()[0]
    edge = newest - dt.timedelta(days=30)
    late = flat.where(F.col("metadata_modified_at") <= F.lit(edge)).count()
    admitted = flat.where((F.col("metadata_modified_at") > F.lit(edge)) & ~(upto & half)).count() + 4
    assert sum(b["late_items"] for b in second) == late and sum(b["admitted_items"] for b in second) == admitted
    assert sum(b["bad_lines"] for b in second) == 3 and sum(b["refused_lines"] for b in second) == 2
    assert sum(b["lines_read"] for b in second) == flat.count() + 7
    assert stream_bronze(spark, f"{landing}/*", bronze, ckpt, delay="30 days", timeout_s=300) == []  # no new file
    counted = spark.read.parquet(f"{bronze}_meta/arrivals")
    assert counted.agg(F.sum("admitted_items")).first()[0] == layers.count_rows(spark, bronze)
    steps = spark.read.parquet(tracker).where("status = 'SUCCESS'").collect()
    assert len(steps) == len(first) + len(second) and {s.reconciliation_status for s in steps} == {"MATCH"}
    # what arrived goes on through the layers
    silver = scratch("silver")
    silver_from_pending(spark, bronze, silver)
    timed = read_silver(spark, silver).where("metadata_modified_at IS NOT NULL")
    assert rows(timed.groupBy("treatment_id").count().where("count > 1")) == []
    assert {r["kind"] for r in rejects(spark, bronze).collect()} == {"line"} and len(glob.glob(f"{bronze}/ingest_run_id=*")) >= 2
