"""Steps over whole items: what is parsed once, read again, or run under settings for wide rows."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from treatment_lake.operators import silver as sv
from treatment_lake.plans import queries_lake, silver_build
from treatment_lake.plans.registry import flat_t
from treatment_lake.session import wide_rows
from treatment_lake.sources import items

from .conftest import SMOKE_DIR, rows

TREATMENT = '{"Item":{"treatment":{"M":{"id":{"N":"%d"},"cost":{"N":"%s"}}},"metadata":{"M":{"modified_at":{"S":"2024-01-0%d 00:00:00"}}}}}'


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_values_that_fail_are_cast_once(spark):
    lines = spark.createDataFrame([(TREATMENT % (1, "abc", 1),), (TREATMENT % (2, "1.5", 2),)], "line string")
    parsed = lines.select(F.from_json("line", items.item_file_schema()).alias("r")).select("r.*")
    found = sv.reject_rows(sv.cast_with_raw(sv.flatten_tagged(sv.bronze_from_items(parsed))))
    assert rows(found) == [("1", "treatment_cost", "abc")]
    assert "Generate" in _plan(found) and "Filter" not in _plan(found).split("Generate")[1]


def test_only_files_with_bad_lines_are_read_again(spark, scratch, monkeypatch):
    export, bronze, read = scratch("export") + "/a b%20c", scratch("bronze"), []
    os.makedirs(export)
    for i, lines in enumerate(([TREATMENT % (1, "1", 1)], ["broken", TREATMENT % (2, "2", 2), '{"x": 1}'], [TREATMENT % (3, "3", 3)])):
        with open(f"{export}/part {i}.json", "w") as f:
            f.write("\n".join(lines))

    def read_items(spark, path):
        read.append([p.rsplit("/", 1)[1] for p in path])
        return items.read_items(spark, path)

    monkeypatch.setattr(silver_build, "read_items", read_items)
    got = silver_build.extract_to_bronze(spark, export, bronze, "r1")
    assert (got["rows"], got["rejected_lines"]) == (3, 2)
    assert sorted(read[0]) == ["part 0.json", "part 1.json", "part 2.json"] and read[1:] == [["part 1.json"]]
    assert rows(silver_build.rejects(spark, bronze).select("kind", "value")) == [("line", "broken"), ("line", "{}")]


def test_item_text_is_made_without_maps(spark):
    flat = flat_t(spark, SMOKE_DIR).withColumn("provider_full_name", F.when(F.col("treatment_id") % 2 == 0, F.lit('a "b"\né')))
    whole = sv.items_from_flat(flat).select(F.concat(F.lit('{"Item":'), F.to_json("Item"), F.lit("}")).alias("value"))
    assert rows(sv.items_json(flat)) == rows(whole)
    assert "map(" in _plan(whole) and "map(" not in _plan(sv.items_json(flat))


def test_steps_over_items_run_under_their_settings(spark, scratch, monkeypatch):
    seen, before = [], {k: spark.conf.get(k, None) for k in wide_rows(spark)}
    write_bronze, write_run, write_table = silver_build.write_bronze, silver_build.write_run, sv.write_table

    def watched(write):
        def run(df, *args):
            seen.append({k: spark.conf.get(k, None) for k in before} == wide_rows(spark))
            return write(df, *args)
        return run

    monkeypatch.setattr(silver_build, "write_bronze", watched(write_bronze))
    monkeypatch.setattr(silver_build, "write_run", watched(write_run))
    monkeypatch.setattr(sv, "write_table", watched(write_table))
    assert queries_lake.q_source_to_silver(spark, SMOKE_DIR).count() == flat_t(spark, SMOKE_DIR).count()
    queries_lake.q_bronze_roundtrip(spark, SMOKE_DIR)
    assert len(seen) > 3 and all(seen) and {k: spark.conf.get(k, None) for k in before} == before


def test_two_runs_derive_the_records_once(spark, monkeypatch):
    calls, snapshot = [], queries_lake.flat_snapshot
    monkeypatch.setattr(queries_lake, "flat_snapshot", lambda *a: calls.append(a) or snapshot(*a))
    queries_lake.q_read_run(spark, SMOKE_DIR)
    assert len(calls) == 1
