"""Which runs a layer has taken in.

One row per run, appended as one small file after the run's data is written:
the row is the commit. A layer loads what the layer before it has
committed and it has not, so a run that stopped in between is taken up by the
next one, whatever the watermarks say.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.layers import read_layer

SCHEMA = "run_id string, seq long, n_rows long, watermark timestamp_ntz"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self):
        return read_layer(self.spark, self.path, self.spark.createDataFrame([], SCHEMA).schema)

    def runs(self) -> list[str]:
        """Committed runs in the order of their commits (one row per run: metadata, not data)."""
        rows = self._rows().groupBy("run_id").agg(F.min("seq").alias("seq")).collect()
        return [r["run_id"] for r in sorted(rows, key=lambda r: (r["seq"], r["run_id"]))]

    def missing(self, upstream: Ledger) -> list[str]:
        """Runs that ``upstream`` has committed and this layer has not."""
        done = set(self.runs())
        return [r for r in upstream.runs() if r not in done]

    def watermark(self) -> dt.datetime | None:
        return self._rows().agg(F.max("watermark").alias("w")).first()["w"]

    def commit(self, run_id: str, n_rows: int, watermark: dt.datetime | None = None) -> None:
        seq = (self._rows().agg(F.max("seq").alias("s")).first()["s"] or 0) + 1
        row = self.spark.createDataFrame([(run_id, seq, n_rows, watermark)], SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)
