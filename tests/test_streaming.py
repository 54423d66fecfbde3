"""File-arrival streaming: each file once, restarts, streaming gold == batch gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from treatment_lake.operators import marts
from treatment_lake.operators.sinks import write_table
from treatment_lake.plans.gold import gold_tables, read_mart
from treatment_lake.plans.registry import silver_t
from treatment_lake.plans.star import build_star
from treatment_lake.schemas import silver_schema
from treatment_lake.sources.tables import read_table
from treatment_lake.streaming.ingest import ingest_files, stream_gold

from .conftest import SMOKE_DIR, rows


def test_each_file_once_across_restarts(spark, scratch):
    ev = read_table(spark, SMOKE_DIR, "events")
    landing, sink, ckpt = scratch("landing"), scratch("sink"), scratch("ckpt")
    write_table(ev.where("event_type = 'click'"), f"{landing}/b1")
    ingest_files(spark, f"{landing}/*", ev.schema, sink, ckpt, timeout_s=300)
    n1 = spark.read.parquet(sink).count()
    write_table(ev.where("event_type <> 'click'"), f"{landing}/b2")
    ingest_files(spark, f"{landing}/*", ev.schema, sink, ckpt, timeout_s=300)
    ingest_files(spark, f"{landing}/*", ev.schema, sink, ckpt, timeout_s=300)  # nothing new
    out = spark.read.parquet(sink)
    assert n1 == ev.where("event_type = 'click'").count()
    assert out.count() == ev.count()
    assert out.select("event_id").distinct().count() == ev.count()


def test_streaming_gold_equals_batch(spark, scratch):
    silver = silver_t(spark, SMOKE_DIR)
    landing, gold, mart_root, ckpt = scratch("landing"), scratch("gold"), scratch("marts"), scratch("ckpt")
    # later statuses arrive first: arrival order must not matter
    for i, st in enumerate(["P", "O", "F"]):
        write_table(silver.where(F.col("treatment_outcome_status") == st), f"{landing}/b{i}")
    stream_gold(spark, f"{landing}/*", silver_schema(), gold, mart_root, ckpt, timeout_s=600)
    star = build_star(silver)
    batch_e1 = marts.provider_treatment_rank(star["fact_treatments"], star["dim_providers"])
    assert rows(read_mart(spark, mart_root, "provider_treatment_rank")) == rows(batch_e1)
    batch_geo = marts.geo_distribution(star["fact_treatments"], star["dim_locations"])
    assert rows(read_mart(spark, mart_root, "geographical_treatment_distribution")) == rows(batch_geo)
    tables = gold_tables(spark, gold)
    for name in ("dim_providers", "dim_patients", "dim_diseases", "fact_treatments"):
        assert rows(tables[name].read()) == rows(star[name]), name
