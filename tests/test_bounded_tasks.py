"""What one task or the driver holds: export files, even layouts, broadcasts, files of an export."""

from __future__ import annotations

import glob
import gzip
import json

from pyspark.sql import functions as F

from treatment_lake.functions.tags import rescued_text
from treatment_lake.operators import silver as sv
from treatment_lake.operators import sinks
from treatment_lake.plans.queries_arrivals import q_new_files_only
from treatment_lake.plans.queries_calendar import q_null_safe_join
from treatment_lake.plans.registry import flat_t, measured_broadcasts
from treatment_lake.sources import items

from .conftest import SMOKE_DIR, rows


def test_export_files_are_compressed_and_of_bounded_length(spark, scratch, monkeypatch):
    monkeypatch.setattr(items, "MAX_LINES", 100)
    flat, path = flat_t(spark, SMOKE_DIR).where("treatment_id < 1000").coalesce(1), scratch("items")
    items.write_items(flat, path)
    files = glob.glob(f"{path}/*.gz")
    lengths = [len(gzip.open(f, "rt").readlines()) for f in files]
    assert max(lengths) <= 100 and len(files) >= 10 and sum(lengths) == flat.count() and not glob.glob(f"{path}/*.txt")
    back = sv.cast_types(sv.flatten_tagged(sv.bronze_from_items(items.read_items(spark, path))))
    assert rows(back.select(*flat.columns)) == rows(flat)


def test_usual_items_are_told_by_their_names(spark, scratch):
    flat, path = flat_t(spark, SMOKE_DIR).limit(2), scratch("items")
    items.write_items(flat, path)
    usual = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    turned = {"Item": dict(reversed(usual[0]["Item"].items()))}
    fewer = {"Item": {k: v for k, v in usual[0]["Item"].items() if k != "disease"}}
    noted = json.loads(json.dumps(usual[0]))
    noted["Item"]["treatment"]["M"]["note"] = {"S": "n"}
    other = scratch("others")
    spark.createDataFrame([(json.dumps(x),) for x in (*usual, turned, fewer, noted)], "value string").write.text(other)
    got = items.read_items(spark, other).select(rescued_text().alias("r"))
    assert sorted((r["r"] or "") for r in got.collect()) == [""] * 4 + ['[{"name":"treatment.note","value":"{\\"S\\":\\"n\\"}"}]']
    # the names are compared before any list of names is made (only unusual items get to the lambdas)
    assert got._jdf.queryExecution().optimizedPlan().toString().index("map_keys") < got._jdf.queryExecution().optimizedPlan().toString().index("array_except")


def test_an_even_layout_bounds_what_a_task_reads(spark, scratch, monkeypatch):
    df, few, many = spark.range(1000).withColumn("x", F.col("id") % 7), scratch("few"), scratch("many")
    sinks.write_layout(df, few, num_partitions=6)
    assert len(glob.glob(f"{few}/*.parquet")) == 6
    monkeypatch.setattr(sinks, "TASK_RECORDS", 50)
    sinks.write_layout(df, many, num_partitions=6)
    assert len(glob.glob(f"{many}/*.parquet")) == 20 and rows(spark.read.parquet(many)) == rows(df)


def test_growing_tables_are_broadcast_by_measured_size_only(spark):
    plan = q_null_safe_join(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    got = measured_broadcasts(spark)
    assert got["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert got["spark.sql.adaptive.autoBroadcastJoinThreshold"] == spark.conf.get("spark.sql.autoBroadcastJoinThreshold")


def test_a_file_of_an_export_may_have_many_parts(spark, monkeypatch):
    monkeypatch.setattr(items, "MAX_LINES", 50)  # each of the files has parts of several tasks
    got = rows(q_new_files_only(spark, SMOKE_DIR).select("run", "files"))
    assert got == [(0, 3), (1, 2), (2, 0)]
