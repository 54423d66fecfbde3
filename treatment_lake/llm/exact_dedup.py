"""Exact deduplication with disk-backed streaming state (operator 5, native).

Texts are equal when identical after lower-casing A-Z only. A narrow table
(digest, stable identifier, content locator) streams through a keyed
aggregation whose state lives in RocksDB and never expires; the state of a
digest is the row that stays (largest identifier), its locator and the
number of rows seen. Every hit is then checked on full bytes: texts are
grouped by (digest, whole normalised text), and a digest that turns out to
hold more than one text is split by the texts themselves, rows joined to
their group on (digest, text).

With ``work_dir`` the state is kept: a later call with the same folder streams only
its own rows into it, and is judged against all earlier arrivals. The folder then
also keeps one row for each different text of a call (its bytes, how many rows
had it and the one that stays), which later texts are compared with.

A hot group (a third of all rows) collapses in the map-side half of each
aggregation, so no task holds it; the final join is between rows and
one row per digest, which AQE splits when skewed.

Defined results
- null text: the empty text, one group with all other empty texts;
- null identifier: sorts below every other; rows that tie on the
  identifier: exactly one of them (of the latest call, with the largest row locator) stays;
- empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .registry import query, stored, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# state on disk; many small stores: no preallocated files, small buffers, one memory limit for all stores of an
# executor, closed soon after the query, and a commit uploads its changes only
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "2",
}


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are; null is empty."""
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _narrow(docs: DataFrame, id_col: str, text_col: str, key_hex: int, arrival: int) -> DataFrame:
    """One row per document: digest, identifier, locator (call, source file, row) and the normalised text."""
    norm = ascii_lower(F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"), F.lit(arrival).alias("arrival"), F.input_file_name().alias("file"),
                        F.monotonically_increasing_id().alias("row"))
            .withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256)).withColumn("key", F.substring("sha", 1, key_hex)))


LOCATOR = ("arrival", "row", "file")


def _best() -> Column:
    return F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", *LOCATOR)).alias("best")


def stream_state(spark: SparkSession, arrivals: str, schema, state_dir: str) -> DataFrame:
    """Feeds the rows under ``arrivals`` that the state has not seen yet, and
    returns the state: one row per digest with ``best`` (identifier and
    locator of the row that stays) and ``rows_seen``. ``state_dir`` holds the
    checkpoint and may be kept for later arrivals."""
    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{state_dir}/changes/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        (spark.readStream.schema(schema).parquet(arrivals)
         .groupBy("key").agg(_best(), F.count(F.lit(1)).alias("rows_seen"))
         .writeStream.outputMode("update").foreachBatch(publish)
         .option("checkpointLocation", f"{state_dir}/checkpoint").trigger(availableNow=True)
         .start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    located = "struct<known:boolean,doc_id:{},arrival:int,row:bigint,file:string>".format(schema["doc_id"].dataType.simpleString())
    changes = spark.read.schema(f"key string, best {located}, rows_seen bigint, batch bigint").parquet(f"{state_dir}/changes")
    # rows_seen only grows, so the newest version of a key is the one with the largest count
    return (changes.groupBy("key").agg(F.max(F.struct("rows_seen", "best")).alias("s"))
            .select("key", "s.rows_seen", "s.best"))


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                work_dir: str | None = None, key_hex: int = 64) -> DataFrame:
    """One row per document of this call: ``doc_id, keep_id, group_size, kept, text_sha256, arrival, file, row``. Groups
    contain the documents of earlier calls with the same ``work_dir``.

    ``key_hex``: hex digits of the digest used as the state's key (all by
    default; fewer make collisions, which the byte check then splits).
    """
    work = work_dir or scratch_path(spark, "exact-dedup")
    arrival = _calls(spark, work) if work_dir else 0
    base = _narrow(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col, key_hex, arrival)
    base.drop("norm").write.mode("append").option("compression", "zstd").parquet(f"{work}/arrivals")
    arrived = spark.read.schema(base.drop("norm").schema).parquet(f"{work}/arrivals")
    rows = arrived.where(F.col("arrival") == arrival)
    if not rows.head(1):
        return (rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("bigint").alias("group_size"),
                            F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "arrival", "file", "row"))
    state = stream_state(spark, f"{work}/arrivals", arrived.schema, f"{work}/state")

    # the check on full bytes: copies collapse on the map side, one row per different text moves
    texts = base.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"), *([_best()] if work_dir else []))
    if work_dir:
        texts.write.mode("append").option("compression", "zstd").parquet(f"{work}/texts")
        texts = spark.read.schema(texts.schema).parquet(f"{work}/texts")
    different = texts.select("key", "norm").distinct() if arrival else texts.select("key", "norm")
    clashes = stored(spark, different.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), scratch_path(spark, "exact-clashes"))

    def decided(own: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
        is_best = F.lit(True)
        for c in LOCATOR:
            is_best = is_best & (F.col(c) == F.col(f"best.{c}"))
        return own.join(groups, on).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", is_best.alias("kept"),
                                           F.col("sha").alias("text_sha256"), *("arrival", "file", "row"))

    groups = state.select("key", F.col("rows_seen").alias("group_size"), "best")
    if not clashes.head(1):
        return decided(rows, groups, ["key"])
    clashed = clashes.select("key")
    by_text = (texts.groupBy("key", "norm").agg(F.sum("n").alias("group_size"), F.max("best").alias("best")) if work_dir
               else base.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("group_size"), _best()))
    split = decided(base.join(clashed, "key", "left_semi"), by_text.join(clashed, "key", "left_semi"), ["key", "norm"])
    return decided(rows.join(clashed, "key", "left_anti"), groups, ["key"]).unionByName(split)


def _calls(spark: SparkSession, work: str) -> int:
    """How many calls have put documents into the folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{work}/arrivals")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return 0
    return (spark.read.schema("arrival int").parquet(f"{work}/arrivals").agg(F.max("arrival")).first()[0] or 0) + 1


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose row ``exact_dedup`` kept, with all their columns."""
    kept = decided.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    sha = F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256)
    out = docs.withColumn("_sha", sha)
    return (out.join(kept, (out["_sha"] == kept["_kept_sha"]) & out[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
            .dropDuplicates(["_sha", id_col]).drop("_sha"))


@query("op5_exact_dedup", f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup(spark, table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
