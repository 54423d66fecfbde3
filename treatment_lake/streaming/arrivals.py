"""Item exports as a stream: files once, items once, late items counted.

``stream_bronze`` reads every export file that its checkpoint has not seen (the file
source's log is the ledger of processed files) and appends what is new to bronze, one run per
micro-batch. An event-time watermark on ``metadata.modified_at`` with keyed
state (RocksDB) recognises an item version it has seen within ``delay`` of the
newest time, however often or in whatever file it comes: items that tie with the
watermark's time are admitted, repeated ones are dropped. Items more than
``delay`` older than the newest time of the batches before are late: dropped by the
watermark and counted. Items without a readable time, and lines that are no
items, pass beside the state.

A row goes to the state with its groups packed as one text (as maps of tags the rows take three times the
shuffle). What the state lets through is stored once, in a scratch table of packed rows that goes when
the batch has been written, so the state is evaluated once a batch.

A batch is counted while it runs: ``BatchCounts`` is a query listener that keeps each
batch's observed metrics and its state operator's late count. They are
compared with the rows written (observed by the write) in the tracker, and kept in
``<bronze>_meta/arrivals``; no batch is read a second time to be counted.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.tags import BRONZE_SCHEMA, RESCUED, packed_groups, unpacked_groups
from ..operators import silver as sv
from ..operators.merge_table import settings
from ..operators.sinks import write_bronze, write_table
from ..operators.tracker import Tracker
from ..plans.silver_build import bronze_time, ledger, line_rejects, write_rejects, write_rescued
from ..session import SHUFFLES_GO, remove, scratch_path, wide_rows
from ..sources import layers
from ..sources.items import CORRUPT, bad_line, is_item, item_reader, modified_at

#: of a row that the state lets through: an item's groups and what has no column, or a line that is no item
ARRIVED = ("packed", RESCUED, "line")
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
         "spark.sql.streaming.stateStore.compression.codec": "zstd",  # digests are hex
         "spark.sql.streaming.stateStore.rocksdb.compression": "zstd"}
ARRIVALS = "ingest_run_id string, batch_id long, lines_read long, items_read long, bad_lines long, late_items long, repeated_lines long, refused_lines long, admitted_items long"


class BatchCounts(StreamingQueryListener):
    """Per micro-batch of one query: what was observed while it ran, and how many rows the watermark dropped."""

    def __init__(self, name: str):
        self.name, self.batches, self.id, self.ended = name, {}, None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.name:
            observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
            held = self.batches.setdefault(p.batchId, {"late": 0, "repeated": 0, "observed": {}})
            held["observed"].update(observed)
            for o in p.stateOperators:
                held["late"] += o.numRowsDroppedByWatermark
                held["repeated"] += int(o.customMetrics.get("numDroppedDuplicateRows", 0))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self.id:
            self.ended.set()


def arrivals(spark: SparkSession, export_glob: str, delay: str, max_files: int | None = None) -> DataFrame:
    """The stream of new lines: ``Item`` or, for what is no item, its text. Lines without a time have a NULL event time, which
    no watermark passes by; the state drops repetitions of them within a batch only."""
    reader = item_reader(spark.readStream)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    item = is_item()
    lines = reader.json(export_glob).withColumn("event_time", F.when(item, modified_at()).cast("timestamp"))
    text = F.when(item, F.to_json("Item")).otherwise(F.concat(F.lit("no item "), F.coalesce(F.col(CORRUPT), F.to_json("Item"), F.lit(""))))
    lines = (lines.observe("read", F.count(F.lit(1)).alias("lines"), F.count_if(item).alias("items"))
             .withColumn("digest", F.sha2(text.cast("binary"), 256)).withColumn("line", bad_line()))
    rows = packed_groups(sv.bronze_from_items(lines, keep=["event_time", "digest", "line"]), "packed")
    return (rows.withColumn("packed", F.when(F.col("line").isNull(), F.col("packed")))
            .withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_time", "digest"]))


def stream_bronze(spark: SparkSession, export_glob: str, bronze_root: str, checkpoint: str, delay: str = "1 hour",
                  tracker_path: str | None = None, max_files: int | None = None, timeout_s: float | None = None) -> list[dict]:
    """One availableNow run over all export files that are new; a dict of ``ARRIVALS`` per micro-batch that had any."""
    name = "arrivals-" + checkpoint.rstrip("/").rsplit("/", 1)[-1]
    listener, written, done = BatchCounts(name), {}, ledger(spark, bronze_root)

    def per_batch(batch: DataFrame, number: int) -> None:
        run = f"{name}-{number:08d}"
        staged = scratch_path(spark, "arrived")
        try:
            write_table(batch.select(*ARRIVED), staged)  # the state is evaluated once, and its rows are stored in columns
            arrived, seen = spark.read.schema(", ".join(f"{c} string" for c in ARRIVED)).parquet(staged), Observation()
            rows = unpacked_groups(arrived.where("line IS NULL").select("packed", RESCUED), "packed")
            rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.max(bronze_time()).alias("wm"), F.count(RESCUED).alias("rescued"))
            write_bronze(rows, bronze_root, run)
            write_rescued(layers.read_run(layers.read_layer(spark, bronze_root, BRONZE_SCHEMA), run), seen.get["rescued"], bronze_root, run)
            bad = line_rejects(arrived.where("line IS NOT NULL"))
            n_bad = bad.count()
            write_rejects([bad] if n_bad else [], bronze_root, run)
        finally:
            remove(spark, staged)
        written[number] = (run, seen.get["n"], n_bad)
        done.commit(run, seen.get["n"], seen.get["wm"])

    spark.streams.addListener(listener)
    try:
        with settings(spark, {**STATE, **SHUFFLES_GO, **wide_rows(spark)}):
            q = (arrivals(spark, export_glob, delay, max_files).writeStream.queryName(name).foreachBatch(per_batch)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
            q.awaitTermination(timeout_s)
        if q.isActive:
            q.stop()
            raise TimeoutError(f"arrivals of {export_glob} did not finish in {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        listener.ended.wait(60)  # events come in order: after this one, all batches are there
    finally:
        spark.streams.removeListener(listener)
    nothing = {"late": 0, "repeated": 0, "observed": {}}
    out = [_counted(run, number, listener.batches.get(number, nothing), n, bad) for number, (run, n, bad) in sorted(written.items())]
    if out:
        write_table(spark.createDataFrame([tuple(r.values()) for r in out], ARRIVALS).coalesce(1), f"{bronze_root}_meta/arrivals", mode="append")
    if tracker_path:
        _track(spark, tracker_path, export_glob, bronze_root, out)
    return out


def _counted(run: str, number: int, batch: dict, admitted: int, refused: int) -> dict:
    read = batch["observed"].get("read", {"lines": 0, "items": 0})
    return {"ingest_run_id": run, "batch_id": number, "lines_read": read["lines"], "items_read": read["items"],
            "bad_lines": read["lines"] - read["items"], "late_items": batch["late"], "repeated_lines": batch["repeated"], "refused_lines": refused, "admitted_items": admitted}


def _track(spark: SparkSession, path: str, source: str, bronze_root: str, batches: Sequence[dict]) -> None:
    """A row per batch: lines read, less those that are late, repeated or refused, against the rows written."""
    for b in batches:
        tracker = Tracker(spark, path, b["ingest_run_id"])
        step = ("arrivals", "source", "bronze", source, bronze_root)
        tracker.started(*step)
        tracker.finished(*step, b["lines_read"] - b["late_items"] - b["repeated_lines"] - b["refused_lines"], b["admitted_items"])
