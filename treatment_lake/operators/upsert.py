"""Upserts (MERGE) as plain frames, and the tables that are replaced as a whole.

``upsert_type1``: matched keys take the source row, unmatched source rows
are inserted, other target rows stay. ``insert_new_only``: only unmatched
source rows are added. Both are one anti join (a shuffle on the key of
both sides; AQE broadcasts whichever side is measured small) plus a union.
NULL keys are removed first: NULL never matches, so it would be inserted on
every run. Tables that are merged into are ``merge_table.MergeTable``.

``RunTable`` is for small tables that are replaced as a whole (marts, partial sums,
the combination registry): a folder per write plus one pointer file that names
the current folder. A write goes to a fresh folder and counts only once the
pointer is there; the pointer is created under a name that must not exist yet, so
of two writers one fails. A failed write leaves the table as it was. Readers of an
older pointer keep their folder for ``KEEP_MINUTES``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import write_table


def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def upsert_type1(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    src = _non_null_keys(source, keys).select(*target.columns)
    kept = target.join(src.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src)


def insert_new_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    src = _non_null_keys(source, keys).select(*target.columns)
    new = src.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


KEEP_MINUTES = 60  # folders that no pointer names go when they are older: readers and other writers may use younger ones


class RunTable:
    """A Parquet table that is one folder per write."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None, keep_minutes: float = KEEP_MINUTES):
        self.spark, self.root, self.schema, self.keep_minutes = spark, root.rstrip("/"), schema, keep_minutes

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *names)))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _files(self, folder: str) -> list:
        fs, path = self._fs(), self._path(folder)
        return sorted(fs.listStatus(path), key=lambda s: s.getPath().getName()) if fs.exists(path) else []

    def _pointers(self) -> list[str]:
        return [n for s in self._files("pointer") if (n := s.getPath().getName()).endswith(".json")]

    def current(self) -> str | None:
        """The folder of the committed table, None before the first commit. A pointer that is still being written has no
        content yet; the one before it counts."""
        for name in reversed(self._pointers()):
            stream = self._fs().open(self._path("pointer", name))
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("}"):
                return json.loads(text)["run"]
        return None

    def _commit(self, run: str, number: int) -> None:
        """Creates the pointer, then removes what is older than ``keep_minutes`` and not named by it."""
        fs = self._fs()
        try:
            out = fs.create(self._path("pointer", f"{number:010d}.json"), False)  # fails if it is there
        except Py4JJavaError as error:
            raise RuntimeError(f"another writer moved the pointer of {self.root}") from error
        out.write(bytearray(json.dumps({"run": run}).encode()))
        out.close()
        oldest = (time.time() - 60 * self.keep_minutes) * 1000
        for s in self._files("runs"):
            if s.getPath().getName() != run and s.getModificationTime() < oldest:
                fs.delete(s.getPath(), True)
        for s in self._files("pointer")[:-2]:
            fs.delete(s.getPath(), False)

    def exists(self) -> bool:
        return self.current() is not None

    def read(self) -> DataFrame:
        run = self.current()
        if run is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/runs/{run}")

    def count(self) -> int:
        return self.read().count()

    def replace(self, df: DataFrame) -> None:
        """``df`` becomes the table."""
        names = self._pointers()
        number = int(names[-1][:-len(".json")]) + 1 if names else 1
        run = uuid.uuid4().hex
        write_table(df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]), f"{self.root}/runs/{run}", mode="errorifexists")
        self._commit(run, number)
