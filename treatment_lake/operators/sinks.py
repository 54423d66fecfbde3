"""Layer writes.

No ``coalesce(1)``: every write is parallel; ``maxRecordsPerFile`` caps
file size and AQE coalesces small shuffle partitions before the write.
Bronze and silver are partitioned by ingest run (a run is read back by
partition pruning, and written again it replaces itself); other tables are
written by ``merge_table.MergeTable`` and ``upsert.RunTable``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.interleave import interleaved_key

DEFAULT_MAX_RECORDS = 5_000_000
#: rows that an even layout gives one task at most: some 400 MB of silver in a shuffle
TASK_RECORDS = 2_000_000


def write_bronze(df: DataFrame, path: str, run_id: str) -> None:
    """One ingest run of the bronze layer (partition ``ingest_run_id``)."""
    write_run(df, path, run_id)


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """One run as its own partition. Written again (after a failure in between) it replaces itself."""
    (df.withColumn("ingest_run_id", F.lit(run_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_run_id")
     .option("compression", "zstd").option("maxRecordsPerFile", DEFAULT_MAX_RECORDS)
     .parquet(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), max_records: int = DEFAULT_MAX_RECORDS) -> None:
    w = df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_records)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """A distribution key that joins and aggregates can use: a catalog table in ``buckets`` hash buckets of ``by``, one file
    each. Tables with the same number of buckets of their join keys are joined, and grouped by them, without an exchange."""
    (df.repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, *by).sortBy(*(sort_by or by)).saveAsTable(table))
    return df.sparkSession.table(table)


def write_layout(df: DataFrame, path: str, distribute_by: Sequence[str] = (),
                 sort_by: Sequence[str] = (), num_partitions: int | None = None,
                 range_by: Sequence[str] = (), mode: str = "overwrite", interleave: Sequence[str] = (),
                 max_records: int = DEFAULT_MAX_RECORDS) -> None:
    """Distribution and sort keys as a write layout.

    ``distribute_by`` clusters by the key (a key beyond the advisory partition
    size is split over several tasks and files), ``range_by`` range-partitions,
    ``interleave`` sorts by the interleaved bits of the columns' value ranks (each
    of them alone then prunes), ``num_partitions`` without a key deals rows
    out evenly (to more partitions, where these would get over ``TASK_RECORDS`` each; the rows are counted for that), ``sort_by`` sorts within each output partition so Parquet
    row-group min/max statistics let later scans skip data.
    """
    out = df
    if interleave:
        keyed = df.withColumn("_z", interleaved_key(df, interleave))
        out = keyed.repartitionByRange(*(([num_partitions] if num_partitions else []) + ["_z"])).sortWithinPartitions("_z").drop("_z")
    elif range_by:
        out = out.repartitionByRange(*(([num_partitions] if num_partitions else []) + list(range_by)))
    elif distribute_by:
        out = out.hint("rebalance", *distribute_by)
    elif num_partitions:
        out = out.repartition(max(num_partitions, -(-df.count() // TASK_RECORDS)))
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    write_table(out, path, mode, max_records=max_records)


def bulk_append(df: DataFrame, target_schema: T.StructType, path: str) -> None:
    """Append by column name, cast to the target types: a missing target column
    becomes a typed NULL, an extra source column is dropped."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target_schema.fields]
    write_table(df.select(*cols), path, mode="append")
