"""Distributed rank / dense rank equal the single-window SQL functions."""

from __future__ import annotations

import duckdb
from pyspark.sql import Window
from pyspark.sql import functions as F

from treatment_lake.operators.ranking import with_position, with_rank
from treatment_lake.plans.oracle_sql import ORACLE
from treatment_lake.plans.queries import QUERIES
from treatment_lake.sources.tables import DRIVER_TABLES

from .conftest import SMOKE_DIR, rows


def test_value_ranks_match_window(spark):
    # 2,000 rows, ~300 distinct values with ties, plus NULLs; the sort spans
    # several partitions, so offsets cross partition boundaries.
    df = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 301).cast("double").alias("v"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep all sort partitions
    try:
        got = with_rank(spark, df, "v", "r")
        got = with_rank(spark, got, "v", "d", dense=True)
        got_rows = rows(got, "id", "v", "r", "d")
    finally:
        spark.conf.set(key, old)
    w = Window.orderBy(F.col("v").desc_nulls_last())
    want = df.select("id", "v", F.rank().over(w).cast("long").alias("r"),
                     F.dense_rank().over(w).cast("long").alias("d"))
    assert got_rows == rows(want)


def test_positions_match_row_number(spark):
    df = spark.range(0, 2000, 1, 7).select("id", ((F.col("id") * 7919) % 301).alias("v"))
    order = [F.col("v").desc_nulls_last(), F.col("id").asc_nulls_last()]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep all sort partitions
    try:
        got = rows(with_position(spark, df, order))
    finally:
        spark.conf.set(key, old)
    assert got == rows(df.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long")))


def test_mart_order_full_has_every_row(spark):
    duck = duckdb.connect()
    for t in DRIVER_TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    want = sorted(duck.execute(f"SELECT mart, position, label FROM ({ORACLE['mart_order_full']})").fetchall())
    assert max(p for _, p, _ in want) > 20
    assert sorted(tuple(r) for r in QUERIES["mart_order_full"](spark, SMOKE_DIR).select("mart", "position", "label").collect()) == want
