"""Step tracker and count reconciliation.

The tracker is append-only: a step writes a STARTED row and later a
SUCCESS or FAILED row under the same ``(run_id, step)``; the latest
status is ``max_by(status, seq)``. Rows are a handful per run (metadata,
not data), so building them on the driver is fine.

Reconciliation: MATCH when both counts are known and equal, MISMATCH when
they differ, SKIPPED when either is unknown (NULL or -1).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRACKER_SCHEMA


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def reconcile(source_count: int | None, destination_count: int | None) -> str:
    if source_count is None or destination_count is None or source_count == -1 or destination_count == -1:
        return "SKIPPED"
    return "MATCH" if source_count == destination_count else "MISMATCH"


def reconcile_col(source: Column, destination: Column) -> Column:
    unknown = source.isNull() | destination.isNull() | (source == -1) | (destination == -1)
    return (F.when(unknown, F.lit("SKIPPED"))
            .when(source == destination, F.lit("MATCH"))
            .otherwise(F.lit("MISMATCH")))


@dataclass
class Tracker:
    """Collects step rows of one run and appends them to the tracker table."""

    spark: SparkSession
    path: str | None
    run_id: str
    clock: Callable[[], dt.datetime] = utc_now
    rows: list[tuple] = field(default_factory=list)

    def _row(self, step, src_layer, dst_layer, src_table, dst_table, status, src_n=None, dst_n=None,
             recon=None, done=False) -> tuple:
        now = self.clock()
        return (self.run_id, len(self.rows) + 1, step, src_layer, dst_layer, src_table, dst_table, status,
                src_n, dst_n, recon, now if done else None, now)

    def started(self, step, src_layer, dst_layer, src_table, dst_table, src_n=None) -> None:
        """Write a STARTED row before the work, so a crash leaves a trace."""
        self.rows.append(self._row(step, src_layer, dst_layer, src_table, dst_table, "STARTED", src_n))
        self.flush()

    def finished(self, step, src_layer, dst_layer, src_table, dst_table, src_n, dst_n) -> str:
        recon = reconcile(src_n, dst_n)
        self.rows.append(self._row(step, src_layer, dst_layer, src_table, dst_table, "SUCCESS", src_n,
                                   dst_n, recon, done=True))
        self.flush()
        return recon

    def failed(self, step, src_layer, dst_layer, src_table, dst_table, src_n=None) -> None:
        self.rows.append(self._row(step, src_layer, dst_layer, src_table, dst_table, "FAILED", src_n,
                                   done=True))
        self.flush()

    _flushed: int = 0

    def flush(self) -> None:
        """Append the rows not yet written (one small file per call)."""
        if self.path is None or self._flushed >= len(self.rows):
            return
        pending = self.rows[self._flushed:]
        self.spark.createDataFrame(pending, TRACKER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self._flushed = len(self.rows)

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, TRACKER_SCHEMA)


def latest_status(tracker: DataFrame) -> DataFrame:
    """One row per (run_id, step): the columns of its highest-``seq`` row."""
    cols = [c for c in tracker.columns if c not in ("run_id", "step")]
    best = F.max_by(F.struct(*cols), F.col("seq")).alias("_last")
    return tracker.groupBy("run_id", "step").agg(best).select("run_id", "step", "_last.*")
