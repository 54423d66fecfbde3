"""Global rank / dense rank without a single-partition window.

``Window.orderBy(x)`` with no partition moves every row to one task. Here
the rows are first reduced to their distinct order values with a count
(partial aggregation, so a value shared by a third of the rows is one row
per map task), the distinct values are sorted with a range-partitioned
sort (many tasks), and each value's position inside its sort partition is
computed there. Per-partition totals - one row per partition, a bound set
by the partition count and not by the data - give the offsets, which are
broadcast. Ranks are joined back on the value (NULL-safe).

The sorted values are written once as a table in the shared folder, so
the partition ids every later step sees are fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .sinks import write_table


def value_ranks(spark: SparkSession, df: DataFrame, col: str, descending: bool = True) -> DataFrame:
    """(``col``, rank, dense_rank) for every distinct value of ``col``, ordered
    by ``col`` (descending by default), NULL last - as SQL ``rank()`` and
    ``dense_rank()`` over ``ORDER BY col [DESC] NULLS LAST``."""
    order = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    part = counts.orderBy(order).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = part.select(col, "_pid", "_cnt",
                        F.row_number().over(Window.partitionBy("_pid").orderBy(order)).alias("_pos"),
                        (F.sum("_cnt").over(w) - F.col("_cnt")).alias("_before"))
    path = scratch_path(spark, "ranks")
    write_table(local, path)
    local = spark.read.schema(local.schema).parquet(path)

    per = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum("_cnt").alias("_c"))
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_pid", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_off_n"),
                         F.coalesce(F.sum("_c").over(prior), F.lit(0)).alias("_off_c"))
    return local.join(F.broadcast(offsets), "_pid").select(
        col,
        (F.col("_off_c") + F.col("_before") + 1).cast("long").alias("rank"),
        (F.col("_off_n") + F.col("_pos")).cast("long").alias("dense_rank"),
    )


def with_position(spark: SparkSession, df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """``df`` plus column ``out`` (long): each row's place in ``order`` over all rows, as SQL ``row_number()``.
    The last of ``order`` should tell rows apart; equal rows are numbered in any order."""
    part = df.orderBy(*order).withColumn("_pid", F.spark_partition_id())
    local = part.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    path = scratch_path(spark, "positions")
    write_table(local, path)
    local = spark.read.schema(local.schema).parquet(path)

    per = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_pid", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.col("_off") + F.col("_pos")).cast("long").alias(out)))


def with_rank(spark: SparkSession, df: DataFrame, col: str, out: str, dense: bool = False,
              descending: bool = True) -> DataFrame:
    """``df`` plus column ``out``: the (dense) rank of ``col`` over all rows."""
    r = value_ranks(spark, df, col, descending)
    r = r.select(F.col(col).alias("_v"), F.col("dense_rank" if dense else "rank").alias(out))
    return df.join(r, df[col].eqNullSafe(r["_v"]), "left").drop("_v")
