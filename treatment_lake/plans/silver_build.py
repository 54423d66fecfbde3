"""Source -> bronze -> silver (P2, P3).

``extract_to_bronze``: item export files -> one bronze ingest run. Only files that
no committed run has read are read (a ledger of path and modification time). Full
mode when bronze has no committed run; otherwise items from the newest time
bronze has committed on (nested ``metadata.modified_at``), less an optional
``lookback``, and items without a readable time. Items at or below the newest time
that a committed run holds are recognised by their digest (``edge``: the digests
from the window's lower end on), so one that ties with the watermark is loaded once, neither
lost nor doubled. Items before the window that bronze does not hold are late:
they go to the reject table and are counted.

``bronze_to_silver``: one bronze run -> the silver partition of that run.
Combination ids come from a small registry table that new pairs extend.

Both write once, count what they write while writing it (``Observation``)
and compare that with the written files, and keep what they refuse: lines
that are no items, late items and values that do not cast go to the reject table,
with their run. Side tables live beside the layer, under ``<layer>_meta``; they
count only for runs that the ledger has. A run is committed by a ledger row after its
data is written; written again it replaces itself.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import BRONZE_SCHEMA, RESCUED
from ..operators import silver as sv
from ..operators.combos import REGISTRY_SCHEMA, assign_with_registry, registry_update
from ..operators.ledger import Ledger
from ..operators.merge_table import settings
from ..operators.sinks import write_bronze, write_run
from ..operators.tracker import Tracker, utc_now
from ..operators.upsert import RunTable
from ..schemas import ITEM_GROUPS, SILVER_COLUMNS, silver_schema
from ..session import wide_rows
from ..sources import layers
from ..sources.items import bad_files, bad_lines, is_item, listed_files, modified_at, read_items, scan_items_window, with_file

REJECT_SCHEMA = "kind string, treatment_id string, column_name string, value string, ingest_run_id string"


def ledger(spark: SparkSession, layer_root: str) -> Ledger:
    return Ledger(spark, f"{layer_root}_meta/ledger")


def rejects(spark: SparkSession, layer_root: str) -> DataFrame:
    """What the runs of a layer refused."""
    return layers.read_layer(spark, f"{layer_root}_meta/rejects", spark.createDataFrame([], REJECT_SCHEMA).schema)


def write_rejects(found: list[DataFrame], layer_root: str, run_id: str) -> None:
    """All that a run refused, in one write (a second one would replace it)."""
    if found:
        whole = found[0]
        for more in found[1:]:
            whole = whole.unionByName(more)
        write_run(whole.select("kind", "treatment_id", "column_name", "value"), f"{layer_root}_meta/rejects", run_id)


RESCUED_SCHEMA = "name string, n long, ingest_run_id string"


def write_rescued(run_rows: DataFrame, n: int, bronze_root: str, run_id: str) -> None:
    """Counts the unknown attributes of a run by name, if it has any."""
    if n:
        write_run(sv.rescued_names(run_rows), f"{bronze_root}_meta/rescued", run_id)


def rescued(spark: SparkSession, bronze_root: str) -> DataFrame:
    """``name, n, ingest_run_id``: what bronze holds beside its columns."""
    return layers.read_layer(spark, f"{bronze_root}_meta/rescued", spark.createDataFrame([], RESCUED_SCHEMA).schema)


def rejected_lines(items: DataFrame) -> DataFrame:
    return line_rejects(bad_lines(items))


def line_rejects(lines: DataFrame) -> DataFrame:
    """Reject rows of the lines (``line``) that are no items."""
    nothing = F.lit(None).cast("string")
    return lines.select(F.lit("line").alias("kind"), nothing.alias("treatment_id"), nothing.alias("column_name"), F.col("line").alias("value"))


def combo_registry(spark: SparkSession, silver_root: str) -> RunTable:
    return RunTable(spark, f"{silver_root}_meta/registry", spark.createDataFrame([], REGISTRY_SCHEMA).schema)


def read_silver(spark: SparkSession, silver_root: str, run_ids: list[str] | None = None) -> DataFrame:
    """The silver rows, of the given runs only (partition pruning)."""
    rows = layers.read_layer(spark, silver_root, silver_schema())
    if run_ids is not None:
        rows = rows.where(F.col("ingest_run_id").isin(run_ids)) if "ingest_run_id" in rows.columns else rows.limit(0)
    return rows.select(*SILVER_COLUMNS)


FILES_SCHEMA = "path string, modified timestamp, ingest_run_id string"
EDGE_SCHEMA = "modified_at timestamp_ntz, digest string, ingest_run_id string"


def _side(spark: SparkSession, layer_root: str, name: str, schema: str, committed: list[str]) -> DataFrame:
    """A side table's rows of committed runs."""
    rows = layers.read_layer(spark, f"{layer_root}_meta/{name}", spark.createDataFrame([], schema).schema)
    return rows.where(F.col("ingest_run_id").isin(committed))


def new_files(spark: SparkSession, items_path: str, bronze_root: str, modified_after: str | None = None) -> DataFrame:
    """``path, modified`` of the export's files that no committed run has read; a file written anew counts as new."""
    read = _side(spark, bronze_root, "files", FILES_SCHEMA, ledger(spark, bronze_root).runs())
    return listed_files(spark, items_path, modified_after).join(read, ["path", "modified"], "left_anti")


def read_files(spark: SparkSession, bronze_root: str, run_id: str) -> DataFrame:
    """``path, modified`` of the files that a committed run has read."""
    done = [r for r in ledger(spark, bronze_root).runs() if r == run_id]
    return _side(spark, bronze_root, "files", FILES_SCHEMA, done).select("path", "modified")


def in_wide_rows(step: Callable) -> Callable:
    """A step that runs under the settings for whole items."""
    @functools.wraps(step)
    def run(spark: SparkSession, *args, **kwargs):
        with settings(spark, wide_rows(spark)):
            return step(spark, *args, **kwargs)
    return run


def bronze_time() -> Column:
    return F.col("metadata")["modified_at"]["S"].try_cast("timestamp_ntz")


def bronze_digest() -> Column:
    """What tells one version of an item from another."""
    return F.sha2(F.to_json(F.struct(*ITEM_GROUPS, RESCUED)).cast("binary"), 256)


def _without_loaded(rows: DataFrame, edge: DataFrame, newest) -> DataFrame:
    """Without bronze rows that the edge has. Rows after the newest committed time cannot be there: they get a key of
    their own, spread over all partitions should the join shuffle."""
    known = bronze_time() <= F.lit(newest).cast("timestamp_ntz")
    key = F.coalesce(F.when(known, bronze_digest()), F.concat(F.lit("new "), F.monotonically_increasing_id().cast("string")))
    return rows.withColumn("_digest", key).join(edge.select(F.col("digest").alias("_digest")), "_digest", "left_anti").drop("_digest")


def _late(items: DataFrame, bronze: DataFrame, low) -> DataFrame:
    """Items before the window that bronze does not hold, as reject rows."""
    def names(group) -> list[Column]:
        t, m = group("treatment"), group("metadata")
        return [F.coalesce(t["id"]["N"], t["id"]["S"]).alias("id"), m["modified_at"]["S"].alias("at")]

    old = items.where(is_item() & (modified_at() < F.lit(low).cast("timestamp_ntz"))).select(
        *names(lambda g: F.col(f"Item.{g}.M")), F.to_json("Item").alias("value"))
    held = bronze.select(*names(F.col)).select(F.col("id").alias("h_id"), F.col("at").alias("h_at"))
    missing = old.join(held, old["id"].eqNullSafe(held["h_id"]) & (old["at"] == held["h_at"]), "left_anti")
    return missing.select(F.lit("late").alias("kind"), F.col("id").alias("treatment_id"), F.lit("metadata_modified_at").alias("column_name"), "value")


def _write_edge(run_rows: DataFrame, edge: DataFrame, newest, lookback: str | None, bronze_root: str, run_id: str) -> None:
    """The digests that the next run's window can meet: those of this run and of the old edge from its lower end on
    (a run with a longer ``lookback`` than the one before may load items again; merges don't mind)."""
    low = F.lit(newest).cast("timestamp_ntz")
    low = low - F.expr(f"INTERVAL {lookback}") if lookback else low
    own = run_rows.select(bronze_time().alias("modified_at"), bronze_digest().alias("digest"))
    both = own.unionByName(edge.select("modified_at", "digest")).where(F.col("modified_at") >= low).distinct()
    write_run(both, f"{bronze_root}_meta/edge", run_id)


def _named(paths: list[str], uris: list[str]) -> list[str]:
    """The paths that the URIs name, escaped or not; all of them, should one URI name none."""
    spelled = [{u, unquote(u)} for u in (u.replace("file:///", "file:/") for u in uris)]
    wanted = set().union(*spelled)
    known = {p.replace("file:///", "file:/"): p for p in paths}
    return [p for k, p in known.items() if k in wanted] if all(s & known.keys() for s in spelled) else paths


@in_wide_rows
def extract_to_bronze(spark: SparkSession, items_path: str, bronze_root: str, run_id: str | None = None,
                      tracker: Tracker | None = None, lookback: str | None = None, clock=utc_now,
                      modified_after: str | None = None, reject_late: bool = True) -> dict:
    """One run over the export's new files. ``reject_late=False`` leaves out the search for late items (a join of the items
    before the window with bronze); they are then counted only within ``older_rows``, with those that bronze holds."""
    run_id = run_id or uuid.uuid4().hex
    done = ledger(spark, bronze_root)
    committed = done.runs()
    mode = "incremental" if committed else "full"
    step = ("extract", "source", "bronze", items_path, bronze_root)
    listed = new_files(spark, items_path, bronze_root, modified_after).collect()  # the names that the scan itself lists
    wm = low = done.watermark() if mode == "incremental" else None
    if wm is not None and lookback:
        low = spark.range(1).select((F.lit(wm).cast("timestamp_ntz") - F.expr(f"INTERVAL {lookback}")).alias("w")).first()["w"]
    if tracker:
        tracker.started(*step)
    try:
        items, edge = with_file(read_items(spark, [r["path"] for r in listed])), _side(spark, bronze_root, "edge", EDGE_SCHEMA, committed[-1:])
        read, kept = Observation(), Observation()
        before = F.lit(False) if low is None else is_item() & (modified_at() < F.lit(low).cast("timestamp_ntz"))
        window = scan_items_window(items.observe(read, F.count_if(~is_item()).alias("bad"), F.count_if(before).alias("older"), bad_files()),
                                   low, clock() if mode == "incremental" else None, keep_unknown=True, with_ties=True)
        rows = sv.bronze_from_items(window.where(is_item()))
        if wm is not None:
            rows = _without_loaded(rows, edge, wm)
        write_bronze(rows.observe(kept, F.count(F.lit(1)).alias("n"), F.max(bronze_time()).alias("wm"),
                                  F.count(RESCUED).alias("rescued")), bronze_root, run_id)
        got, layer = {**read.get, **kept.get}, layers.read_layer(spark, bronze_root, BRONZE_SCHEMA)
        search = bool(got["older"]) and reject_late
        refused = [rejected_lines(read_items(spark, _named([r["path"] for r in listed], got["bad_files"])))] if got["bad"] else []
        if search:
            refused.append(_late(items, layer.where(F.col("ingest_run_id").isin(committed)), low))
        write_rejects(refused, bronze_root, run_id)
        late = layers.read_run(rejects(spark, bronze_root), run_id).where("kind = 'late'").count() if search else 0
        newest = max((t for t in (wm, got["wm"]) if t is not None), default=None)
        if newest is not None:
            _write_edge(layers.read_run(layer, run_id), edge, newest, lookback, bronze_root, run_id)
        write_rescued(layers.read_run(layer, run_id), got["rescued"], bronze_root, run_id)
        if listed:
            write_run(spark.createDataFrame(listed, "path string, modified timestamp"), f"{bronze_root}_meta/files", run_id)
        written = layers.read_run(layer, run_id).count()
        done.commit(run_id, written, got["wm"])
    except Exception:
        if tracker:
            tracker.failed(*step)
        raise
    if tracker:
        tracker.finished(*step, got["n"], written)
    return {"run_id": run_id, "mode": mode, "rows": written, "rejected_lines": got["bad"], "files": len(listed),
            "older_rows": got["older"], "late_rows": late, "rescued_rows": got["rescued"]}


@in_wide_rows
def bronze_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, run_id: str,
                     tracker: Tracker | None = None) -> dict:
    done = ledger(spark, silver_root)
    mode = "incremental" if done.runs() else "full"
    step = ("transform", "bronze", "silver", bronze_root, silver_root)
    bronze = layers.read_run(layers.read_layer(spark, bronze_root, BRONZE_SCHEMA), run_id)
    both = sv.cast_with_raw(sv.flatten_tagged(bronze))
    if tracker:
        tracker.started(*step)
    try:
        pairs = combo_registry(spark, silver_root)
        pairs.replace(registry_update(pairs.read() if pairs.exists() else None, both))
        seen = Observation()
        both = both.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("n_rejects").alias("bad"))
        write_run(assign_with_registry(both, pairs.read()).select(*SILVER_COLUMNS), silver_root, run_id)
        got = seen.get
        if got["bad"]:
            cells = sv.reject_rows(sv.cast_with_raw(sv.flatten_tagged(bronze)))
            write_rejects([cells.select(F.lit("value").alias("kind"), "treatment_id", "column_name", "value")], silver_root, run_id)
        written = read_silver(spark, silver_root, [run_id]).count()
        done.commit(run_id, written)
    except Exception:
        if tracker:
            tracker.failed(*step)
        raise
    if tracker:
        tracker.finished(*step, got["n"], written)
    return {"run_id": run_id, "mode": mode, "rows": written, "rejected_values": got["bad"] or 0}


def silver_from_pending(spark: SparkSession, bronze_root: str, silver_root: str, tracker: Tracker | None = None) -> list[dict]:
    """Every run that bronze has committed and silver has not, in order."""
    pending = ledger(spark, silver_root).missing(ledger(spark, bronze_root))
    return [bronze_to_silver(spark, bronze_root, silver_root, run, tracker) for run in pending]


def reset_layer(spark: SparkSession, layer_root: str) -> None:
    """An empty layer: its data, ledger, registry and rejects go, and the next run is a full load."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in (f"{layer_root}_meta", layer_root):  # the commits first: what is left of the data then counts for nothing
        p = hadoop.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
