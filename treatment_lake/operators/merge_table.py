"""Tables that merges rewrite part by part.

``MergeTable`` is a Parquet table partitioned by ``_part``, an int: a hash of the
key (the same key is always in the same part), or an expression of the row
such as its month. A merge rewrites the parts its source touches with
Spark's dynamic partition overwrite; files of all other parts stay as they are.

With hash parts the touched parts are those of the source's keys. With parts that
depend on other columns a key's old row may lie elsewhere: it is looked up in
the key range of the source (files are sorted by key, so the range skips row
groups) by a semi join for which Spark plans a Bloom filter of the source's keys
at the scan, unless the source is small enough to be broadcast.

A merge into a table with rows is staged first, then a log entry names the staged
folder, then the parts are overwritten, then the entry is closed. A driver that
dies in between leaves an open entry; the next use of the table repeats the
overwrite from the staged folder. Applying a merge twice changes nothing. One
writer at a time; who reads while parts are overwritten may have to read again.

With ``feed`` each merge also leaves what it changed: the rows that went (sign -1)
and those that came (+1), for incremental aggregates. The first load leaves no
feed: it is the whole table.

Rows are counted while they are written (``Observation``): those of the source
that have a key, and how many of these keys are among the rows written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .sinks import DEFAULT_MAX_RECORDS, write_table

PART = "_part"
#: so that the lookup of old rows gets a Bloom filter of the source's keys wherever the source is not broadcast
BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
         "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
         "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


@dataclass(frozen=True)
class Merged:
    number: int
    source_rows: int
    written_keys: int
    touched: tuple[int, ...]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def has_keys(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


class MergeTable:
    """``keys``: one row each. ``version``: a stored column that merges compare and ``read`` hides; without one the source
    wins, or with ``insert_only`` the target. ``part``: an int expression; without one rows are dealt into ``buckets`` by
    a hash of the key (kept with the table when it is made). ``visible``: the rows that ``read`` shows."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], version: str | None = None,
                 part: Column | None = None, buckets: int = 16, visible: str | None = None, insert_only: bool = False, feed: bool = False):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        self.version, self.part, self.visible, self.insert_only, self.feed = version, part, visible, insert_only, feed
        self.buckets = buckets

    # --- log ---------------------------------------------------------------

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *names)))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _log(self) -> list[str]:
        fs, path = self._fs(), self._path("log")
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _note(self, name: str, content: dict) -> None:
        out = self._fs().create(self._path("log", name), True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()

    def _noted(self, name: str) -> dict:
        stream = self._fs().open(self._path("log", name))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> int:
        """Number of the last finished merge, 0 before the first."""
        self._recover()
        return max((int(n.split(".")[0]) for n in self._log() if n.endswith(".done")), default=0)

    def exists(self) -> bool:
        return self.last() > 0

    def _recover(self) -> None:
        """Repeats the overwrite of a merge that was staged and not finished."""
        names = set(self._log())
        for name in sorted(n for n in names if n.endswith(".staged")):
            if name.replace(".staged", ".done") not in names:
                self._apply(int(name.split(".")[0]), self._noted(name))

    def _apply(self, number: int, entry: dict) -> None:
        staged = f"{self.root}/stage/{number:010d}"
        rows = self.spark.read.schema(self._stored(PART)).parquet(staged)
        (rows.sortWithinPartitions(PART, *self.keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").option("maxRecordsPerFile", DEFAULT_MAX_RECORDS).partitionBy(PART).parquet(f"{self.root}/data"))
        for part in entry["emptied"]:  # no row is left to overwrite them with
            self._fs().delete(self._path("data", f"{PART}={part}"), True)
        self._finish(number, entry)
        self._fs().delete(self._path("stage", f"{number:010d}"), True)

    def _finish(self, number: int, entry: dict) -> None:
        self._note(f"{number:010d}.done", entry)
        for name in self._log():
            if int(name.split(".")[0]) < number:
                self._fs().delete(self._path("log", name), False)

    # --- reading -----------------------------------------------------------

    def _stored(self, *more: str) -> T.StructType:
        extra = [T.StructField(self.version, T.TimestampNTZType())] if self.version else []
        return T.StructType([*self.schema.fields, *extra, *(T.StructField(c, T.IntegerType()) for c in more)])

    def _rows(self) -> DataFrame:
        if not self._fs().exists(self._path("data")):
            return self.spark.createDataFrame([], self._stored(PART))
        return self.spark.read.schema(self._stored(PART)).parquet(f"{self.root}/data")

    def read_stored(self) -> DataFrame:
        self._recover()
        return self._rows().drop(PART)

    def read(self) -> DataFrame:
        rows = self.read_stored()
        return (rows.where(self.visible) if self.visible else rows).select(*self.schema.fieldNames())

    def count(self) -> int:
        return self.read().count()

    def changes(self, after: int) -> DataFrame | None:
        """``sign`` and the visible columns of what the merges after number ``after`` changed; None if not all are there."""
        last, fs = self.last(), self._fs()
        folders = [("changes", f"merge={n}") for n in range(after + 1, last + 1)]
        if not self.feed or after < 1 or not all(fs.exists(self._path(*f)) for f in folders):
            return None
        schema = T.StructType([T.StructField("sign", T.IntegerType()), *self.schema.fields])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*["/".join((self.root, *f)) for f in folders])

    def forget_changes(self, upto: int) -> None:
        fs, path = self._fs(), self._path("changes")
        for s in fs.listStatus(path) if fs.exists(path) else ():
            if int(s.getPath().getName().split("=")[1]) <= upto:
                fs.delete(s.getPath(), True)

    # --- merging -----------------------------------------------------------

    def _part_of(self, df: DataFrame, buckets: int) -> DataFrame:
        part = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)) if self.part is None else F.coalesce(self.part, F.lit(0))
        return df.withColumn(PART, part.cast("int"))

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.where(has_keys(self.keys)).select(*[F.col(f.name).cast(f.dataType) for f in self._stored().fields])

    def _winners(self, old: DataFrame | None, src: DataFrame) -> DataFrame:
        """One row per key, and whether the source has the key (``_hit``). The pick does not depend on the order of rows."""
        names = self._stored().fieldNames()
        both = src.select(*names, F.lit(1).alias("_src"))
        if old is not None:
            both = both.unionByName(old.select(*names, F.lit(0).alias("_src")))
        first = F.col(self.version) if self.version else -F.col("_src") if self.insert_only else F.col("_src")
        rest = [c for c in names if c not in self.keys]
        best = F.max(F.struct(first.alias("_first"), *[F.col(c) for c in rest])).alias("_best")
        return (both.groupBy(*self.keys).agg(best, F.max("_src").alias("_hit"))
                .select(*[F.col(c) if c in self.keys else F.col(f"_best.{c}").alias(c) for c in names], "_hit"))

    def _write(self, rows: DataFrame, path: str, buckets: int) -> int:
        """Rows with ``_hit`` to a folder, clustered by part and sorted by key; how many of the source's keys are among them."""
        seen = Observation()
        counted = rows.observe(seen, F.sum("_hit").alias("hits")).drop("_hit")
        dealt = self._part_of(counted, buckets).hint("rebalance", PART).sortWithinPartitions(PART, *self.keys)
        (dealt.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", DEFAULT_MAX_RECORDS)
         .partitionBy(PART).parquet(path))
        return int(seen.get["hits"] or 0)

    def found(self, held: DataFrame, src: DataFrame, lo, hi) -> DataFrame:
        """The rows of ``held`` whose key the source has; the source's first key column lies between ``lo`` and ``hi``."""
        if lo is None:
            return held.limit(0)
        inside = F.col(self.keys[0]).between(F.lit(lo), F.lit(hi))
        return held.where(inside).join(src.where(inside).select(*self.keys), self.keys, "left_semi")

    def merge(self, source: DataFrame) -> Merged:
        """Merges ``source`` (any frame: it is evaluated once). NULL keys take no part."""
        number = self.last() + 1
        src, seen = self._typed(source), Observation()
        if number == 1:
            src = src.observe(seen, F.count(F.lit(1)).alias("n"))
            hits = self._write(self._winners(None, src), f"{self.root}/data", self.buckets)
            self._note(f"{number:010d}.done", {"buckets": self.buckets, "touched": [], "emptied": []})
            return Merged(number, int(seen.get["n"]), hits, ())
        buckets = self._noted(self._log()[-1])["buckets"]
        src = src.observe(seen, F.count(F.lit(1)).alias("n"), F.min(self.keys[0]).alias("lo"), F.max(self.keys[0]).alias("hi"))
        staged = f"{self.root}/stage/{number:010d}"
        if self.part is None and buckets == 1:
            parts = left = {0}
            hits = self._write(self._winners(self._rows(), src), staged, buckets)
        else:
            given = scratch_path(self.spark, "merge-source")
            write_table(self._part_of(src, buckets), given)
            src, got = self.spark.read.schema(self._stored(PART)).parquet(given), seen.get
            with settings(self.spark, BLOOM):
                parts = {r[0] for r in src.select(PART).distinct().collect()}  # a bounded domain
                if self.part is not None:
                    parts |= {r[0] for r in self.found(self._rows(), src, got["lo"], got["hi"]).select(PART).distinct().collect()}
                old = self._rows().where(F.col(PART).isin(sorted(parts)))
                hits = self._write(self._winners(old, src), staged, buckets)
                new = self.spark.read.schema(self._stored(PART)).parquet(staged)
                if self.feed:
                    self._write_changes(*(self.found(rows, src, got["lo"], got["hi"]) for rows in (old, new)), number)
            left = parts if self.part is None else {r[0] for r in new.select(PART).distinct().collect()}
        entry = {"buckets": buckets, "touched": sorted(parts), "emptied": sorted(parts - left)}
        self._note(f"{number:010d}.staged", entry)
        self._apply(number, entry)
        return Merged(number, int(seen.get["n"]), hits, tuple(sorted(parts)))

    def _write_changes(self, old: DataFrame, new: DataFrame, number: int) -> None:
        names = self.schema.fieldNames()
        shown = [df.where(self.visible) if self.visible else df for df in (old, new)]
        both = shown[0].select(F.lit(-1).alias("sign"), *names).unionByName(shown[1].select(F.lit(1).alias("sign"), *names))
        changed = both.groupBy(*names).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")
        write_table(changed.select("sign", *names), f"{self.root}/changes/merge={number}")
