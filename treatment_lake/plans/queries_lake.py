"""Named queries: upserts, latest rows, incremental scans, layer round trips,
file metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import BRONZE_SCHEMA
from ..operators import silver as sv
from ..operators.dedupe import latest_per_key
from ..operators.merge_table import MergeTable, settings
from ..operators.sinks import bulk_append, write_bronze, write_layout, write_table
from ..operators.upsert import insert_new_only, upsert_type1
from ..schemas import FACT_SCHEMA, WATERMARK_COLUMN, silver_schema
from ..session import scratch_path, wide_rows
from ..sources import layers
from ..sources.items import read_items, scan_items_window, write_items, write_lines
from ..sources.tables import Tables, read_table
from .end_to_end import FIXED_CLOCK, Layout, run_once
from .gold import gold_tables
from .queries import text_with_bad_values
from .registry import flat_snapshot, flat_t, measured_broadcasts, query, silver_snapshot, silver_t
from .silver_build import bronze_to_silver, extract_to_bronze, read_silver, rejects, reset_layer

# --- upserts (D0, D0b, D10) --------------------------------------------------------


def _upsert_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Target: finished and open orders. Source: urgent and high-priority orders
    (some already in the target, some new) with a changed price."""
    o = Tables(spark, sf_dir).orders
    target = o.where(F.col("o_orderstatus").isin("F", "O"))
    source = (o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
              .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return target, source


@query("upsert_type1")
def q_upsert_type1(spark, sf_dir):
    target, source = _upsert_inputs(spark, sf_dir)
    return upsert_type1(target, source, ["o_orderkey"])


@query("insert_new_only")
def q_insert_new_only(spark, sf_dir):
    target, source = _upsert_inputs(spark, sf_dir)
    return insert_new_only(target, source, ["o_orderkey"])


@query("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


# --- incremental (A2, B4, B5, S4-S6, E12) ------------------------------------------

SCAN_LO, SCAN_HI = "1995-01-01 00:00:00", "1997-01-01 00:00:00"
LOADED_BEFORE = "2024-01-15 00:00:00"


@query("incremental_scan")
def q_incremental_scan(spark, sf_dir):
    """Items whose nested modified_at lies in (lo, hi]."""
    items = sv.items_from_flat(flat_t(spark, sf_dir))
    picked = scan_items_window(items, SCAN_LO, SCAN_HI)
    flat = sv.cast_types(sv.flatten_tagged(sv.bronze_from_items(picked)))
    return flat.select("treatment_id", "metadata_modified_at")


def _events_after_loaded(spark, sf_dir, lookback: str | None) -> DataFrame:
    events = Tables(spark, sf_dir).events
    loaded = events.where(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    wm = layers.watermark_value(loaded, "ts")
    return layers.incremental_filter(events, wm, None, "ts", lookback)


@query("incremental_filter")
def q_incremental_filter(spark, sf_dir):
    """Rows newer than the watermark of the already-loaded part (a pushed-down literal)."""
    return _events_after_loaded(spark, sf_dir, None)


@query("incremental_lookback")
def q_incremental_lookback(spark, sf_dir):
    """As incremental_filter, re-reading one hour below the watermark."""
    return _events_after_loaded(spark, sf_dir, "1 HOUR")


@query("watermark")
def q_watermark(spark, sf_dir):
    return layers.watermark(Tables(spark, sf_dir).events, "ts")


@query("load_mode")
def q_load_mode(spark, sf_dir):
    path = scratch_path(spark, "layer")
    write_table(Tables(spark, sf_dir).events, path)
    empty = scratch_path(spark, "empty-layer")
    full = layers.read_layer(spark, path).agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit("events").alias("layer"), F.lit(layers.load_mode(spark, path)).alias("mode"), "n_rows")
    none = spark.range(1).select(F.lit("empty").alias("layer"),
                                 F.lit(layers.load_mode(spark, empty)).alias("mode"),
                                 F.lit(0).cast("long").alias("n_rows"))
    return full.unionByName(none)


@query("latest_batch_count")
def q_latest_batch_count(spark, sf_dir):
    top = layers.rows_at_watermark(flat_snapshot(spark, sf_dir))
    return top.agg(F.max("metadata_modified_at").alias("watermark"), F.count(F.lit(1)).alias("n_rows"))


# --- counts (A3, E13, E14) --------------------------------------------------------

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("count_rows")
def q_count_rows(spark, sf_dir):
    parts = [read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in COUNTED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("multi_source_count")
def q_multi_source_count(spark, sf_dir):
    names = ("orders", "lineitem", "customer")
    parts = [read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")) for t in names]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.sum("n").alias("total_source_count")) \
        .select(F.lit(", ".join(names)).alias("source_tables"), "total_source_count")


# --- layer round trips (A6, A7, A13-A15, W1-W2, P2-P3) ------------------------------

def _bronze_two_runs(spark, sf_dir) -> str:
    """Item files -> bronze in two ingest runs: finished orders, then the rest."""
    flat = flat_snapshot(spark, sf_dir)
    first = F.col("treatment_outcome_status") == "F"
    root = scratch_path(spark, "bronze")
    for run, cond in (("r1", first), ("r2", ~first | F.col("treatment_outcome_status").isNull())):
        items_path = scratch_path(spark, f"items-{run}")
        with settings(spark, wide_rows(spark)):
            write_items(flat.where(cond), items_path)
            write_bronze(sv.bronze_from_items(read_items(spark, items_path)), root, run)
    return root


@query("bronze_roundtrip")
def q_bronze_roundtrip(spark, sf_dir):
    bronze = layers.read_layer(spark, _bronze_two_runs(spark, sf_dir), BRONZE_SCHEMA)
    return sv.to_silver(bronze)


@query("read_run")
def q_read_run(spark, sf_dir):
    bronze = layers.read_layer(spark, _bronze_two_runs(spark, sf_dir), BRONZE_SCHEMA)
    one = layers.read_run(bronze, "r2")
    return sv.typed_rows(one)


@query("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_table(silver_t(spark, sf_dir), path)
    return layers.read_layer(spark, path, silver_schema())


@query("bulk_append")
def q_bulk_append(spark, sf_dir):
    """Silver file of finished orders, then a file of the others appended by column
    name (columns reordered, ``metadata_added_at`` absent -> NULL)."""
    silver = silver_snapshot(spark, sf_dir)
    path = scratch_path(spark, "silver-append")
    first = F.col("treatment_outcome_status") == "F"
    write_table(silver.where(first), path)
    later = silver.where(~first | first.isNull()).drop("metadata_added_at")
    bulk_append(later.select(*reversed(later.columns)), silver_schema(), path)
    return layers.read_layer(spark, path, silver_schema())


@query("write_layout_even")
def q_write_layout_even(spark, sf_dir):
    path = scratch_path(spark, "silver-even")
    write_layout(silver_t(spark, sf_dir), path, num_partitions=6)
    return layers.read_layer(spark, path, silver_schema())


@query("write_layout_range")
def q_write_layout_range(spark, sf_dir):
    path = scratch_path(spark, "silver-range")
    write_layout(silver_snapshot(spark, sf_dir), path, range_by=["treatment_start_date", "provider_id"], sort_by=["provider_id"])
    return layers.read_layer(spark, path, silver_schema())


@query("write_layout")
def q_write_layout(spark, sf_dir):
    path = scratch_path(spark, "silver-layout")
    write_layout(silver_t(spark, sf_dir), path, distribute_by=["patient_id"],
                 sort_by=["treatment_start_date", "treatment_completion_date"])
    return layers.read_layer(spark, path, silver_schema())


def _events_in_batches(spark, sf_dir) -> tuple[str, DataFrame]:
    events = Tables(spark, sf_dir).events
    root = scratch_path(spark, "batches")
    et = F.col("event_type")
    for name, cond in (("batch_001", et == "click"), ("batch_002", et == "view"),
                       ("batch_003", ~et.isin("click", "view") | et.isNull())):
        write_table(events.where(cond), f"{root}/{name}")
    return root, events


@query("latest_file")
def q_latest_file(spark, sf_dir):
    root, events = _events_in_batches(spark, sf_dir)
    df = layers.read_layer(spark, root, events.schema, recursive=True)
    return layers.latest_file_rows(df, by="name", unit="dir")


@query("latest_file_mtime")
def q_latest_file_mtime(spark, sf_dir):
    """Folders written in the reverse order of their names: the newest by time is the first by name."""
    events = Tables(spark, sf_dir).events
    root = scratch_path(spark, "batches")
    et = F.col("event_type")
    for name, cond in (("batch_003", ~et.isin("click", "view") | et.isNull()), ("batch_002", et == "view"), ("batch_001", et == "click")):
        write_table(events.where(cond), f"{root}/{name}")
    df = layers.read_layer(spark, root, events.schema, recursive=True)
    return layers.latest_file_rows(df, by="mtime", unit="dir")


@query("file_filter")
def q_file_filter(spark, sf_dir):
    """Parquet and JSON files under one root; only ``*.parquet`` is read."""
    events = Tables(spark, sf_dir).events
    root = scratch_path(spark, "mixed")
    write_table(events, f"{root}/parquet")
    events.write.mode("overwrite").json(f"{root}/json")
    return layers.read_layer(spark, root, events.schema, glob="*.parquet", recursive=True)


@query("pipeline_silver")
@query("source_to_silver")
def q_source_to_silver(spark, sf_dir):
    """Item export -> bronze run -> silver table, read back."""
    items_path = scratch_path(spark, "export")
    with settings(spark, measured_broadcasts(spark)):
        write_items(flat_t(spark, sf_dir), items_path)
    bronze_root = scratch_path(spark, "bronze")
    silver_root = scratch_path(spark, "silver")
    run = extract_to_bronze(spark, items_path, bronze_root)
    bronze_to_silver(spark, bronze_root, silver_root, run["run_id"])
    return read_silver(spark, silver_root)


@query("export_window")
def q_export_window(spark, sf_dir):
    """The window scan over item files."""
    path = scratch_path(spark, "export")
    write_items(flat_t(spark, sf_dir), path)
    picked = scan_items_window(read_items(spark, path), SCAN_LO, SCAN_HI)
    return sv.cast_types(sv.flatten_tagged(sv.bronze_from_items(picked))).select("treatment_id", "metadata_modified_at")


@query("empty_export")
def q_empty_export(spark, sf_dir):
    """A run over an export, then a run over an export that is not there."""
    items_path, bronze_root = scratch_path(spark, "export"), scratch_path(spark, "bronze")
    write_items(flat_t(spark, sf_dir), items_path)
    runs = [("export", extract_to_bronze(spark, items_path, bronze_root)),
            ("missing", extract_to_bronze(spark, scratch_path(spark, "no-export"), bronze_root))]
    return spark.createDataFrame([(name, r["mode"], r["rows"]) for name, r in runs], "source string, mode string, n_rows long")


@query("pipeline_rejects")
def q_pipeline_rejects(spark, sf_dir):
    """An export with values that do not cast and lines that are no items: what the pipeline refused, by kind and column."""
    items_path, bronze_root, silver_root = (scratch_path(spark, n) for n in ("export", "bronze", "silver"))
    with settings(spark, measured_broadcasts(spark)):
        write_lines(sv.items_json(text_with_bad_values(spark, sf_dir)), items_path)
    broken = Tables(spark, sf_dir).orders.where("o_orderstatus = 'P'").select(
        F.concat(F.lit('{"Item": {"treatment": '), F.col("o_orderkey").cast("string")).alias("value"))
    write_lines(broken, items_path, "append")
    run = extract_to_bronze(spark, items_path, bronze_root)
    bronze_to_silver(spark, bronze_root, silver_root, run["run_id"])
    both = rejects(spark, bronze_root).unionByName(rejects(spark, silver_root))
    return both.groupBy("kind", "column_name").agg(F.count(F.lit(1)).alias("n"))


@query("layer_reset")
def q_layer_reset(spark, sf_dir):
    """A loaded layer, the same layer after its reset, and after it was loaded again."""
    items_path, bronze_root = scratch_path(spark, "export"), scratch_path(spark, "bronze")
    with settings(spark, measured_broadcasts(spark)):
        write_items(flat_t(spark, sf_dir), items_path)
    out = []
    for state in ("loaded", "reset", "loaded again"):
        if state == "reset":
            reset_layer(spark, bronze_root)
            out.append((state, layers.load_mode(spark, bronze_root), 0))
        else:
            run = extract_to_bronze(spark, items_path, bronze_root)
            out.append((state, run["mode"], run["rows"]))
    return spark.createDataFrame(out, "state string, mode string, n_rows long")


FACT_WITHOUT_ID = [c for c in FACT_SCHEMA.fieldNames() if c != "treatment_type_and_outcome_status_sk"]


@query("resume_after_failure")
def q_resume_after_failure(spark, sf_dir):
    """A run that stopped after bronze, one that stopped after silver, then a whole run: the fact holds them all."""
    flat = flat_snapshot(spark, sf_dir)
    layout = Layout(scratch_path(spark, "lake"))
    early = F.col("metadata_modified_at") <= F.lit(SCAN_LO).cast("timestamp_ntz")
    middle = F.col("metadata_modified_at") <= F.lit(SCAN_HI).cast("timestamp_ntz")

    def export(rows):
        path = scratch_path(spark, "export")
        write_items(rows, path)
        return path

    clock = lambda: FIXED_CLOCK
    extract_to_bronze(spark, export(flat.where(early)), layout.bronze, "r1", clock=clock)
    run = extract_to_bronze(spark, export(flat.where(middle)), layout.bronze, "r2", clock=clock)
    bronze_to_silver(spark, layout.bronze, layout.silver, run["run_id"])
    run_once(spark, export(flat), layout, "r3", clock=clock)
    return gold_tables(spark, layout.gold)["fact_treatments"].read().select(FACT_WITHOUT_ID)


@query("upsert_late_version")
def q_upsert_late_version(spark, sf_dir):
    """The newer version of some orders is merged first, then an older one of all of them."""
    orders = Tables(spark, sf_dir).orders
    schema = orders.select("o_orderkey", "o_totalprice").schema
    table = MergeTable(spark, scratch_path(spark, "late"), schema, ["o_orderkey"], version=WATERMARK_COLUMN)
    newer = orders.where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias(WATERMARK_COLUMN))
    older = orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias(WATERMARK_COLUMN))
    table.merge(newer)
    table.merge(older)
    return table.read()
