"""Registry of this subpackage's queries and of their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: str = "16m") -> None:
    """Limits the bytes, not only the rows, of what goes to a Python worker at once, unless the session already does:
    ten thousand very long texts would not fit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "-1", str(2**31 - 1), f"{2**31 - 1}b", "64m", "64MB", "67108864b", "67108864"):
        spark.conf.set(key, size)


def stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the
    lineage, and a lost executor costs a file re-read, not a recompute."""
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
