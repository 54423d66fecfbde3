"""File-arrival processing with Structured Streaming (S1-S3).

The reference reacts to an object-created event and loads only the newest
file. Here a file stream source watches the landing folder: every file
that appears is processed exactly once (the source's checkpoint records
what was read), and a run with ``availableNow`` processes all that is
waiting and stops - a scheduled job needs no always-on cluster.

``ingest_files``: landing files -> Parquet sink (exactly-once file sink).
``stream_gold``: landing silver files -> ``foreachBatch`` that merges the
nine gold tables; the marts follow at the end. Merges depend neither on the
order of batches nor on how often one is replayed; tracker rows carry the
batch id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.marts import FIRST
from ..operators.tracker import Tracker
from ..plans.gold import build_gold, gold_tables, write_marts


def watch(spark: SparkSession, landing_glob: str, schema: T.StructType, fmt: str = "parquet",
          max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_glob)


def ingest_files(spark: SparkSession, landing_glob: str, schema: T.StructType, sink_path: str,
                 checkpoint: str, fmt: str = "parquet", timeout_s: float | None = None) -> None:
    """Process every not-yet-seen landing file into the sink, then stop."""
    q = (watch(spark, landing_glob, schema, fmt).writeStream
         .format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"ingest of {landing_glob} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_gold(spark: SparkSession, landing_glob: str, silver_schema: T.StructType, gold_root: str,
                mart_root: str, checkpoint: str, tracker_path: str | None = None,
                success_ids: Sequence[int] | str = FIRST, timeout_s: float | None = None,
                success_statuses: Sequence[str] | None = None, refresh_marts: bool = True) -> None:
    """One availableNow run: each micro-batch of new silver rows is merged into
    gold; the marts are rebuilt once, after the last one (or, with
    ``refresh_marts=False``, on a trigger of their own)."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        tracker = Tracker(spark, tracker_path, f"batch-{batch_id}") if tracker_path else None
        build_gold(spark, batch, gold_root, tracker, silver_name=landing_glob)

    q = (watch(spark, landing_glob, silver_schema).writeStream
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"gold stream over {landing_glob} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if refresh_marts:
        tables = gold_tables(spark, gold_root)
        if all(t.exists() for t in tables.values()):
            write_marts(spark, tables, mart_root, success_ids, success_statuses)
