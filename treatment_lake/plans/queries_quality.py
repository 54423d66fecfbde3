"""Named queries: quality checks, reconciliation, the step tracker."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import check_all_orphans, check_lengths, check_not_null, check_unique
from ..operators.tracker import Tracker, latest_status, reconcile_col
from ..schemas import DIM_LENGTHS, FOREIGN_KEYS, SILVER_LENGTHS, TRACKER_SCHEMA
from ..session import scratch_path
from ..sources.tables import Tables
from .gold import build_gold
from .registry import query, silver_snapshot, silver_t, star_t
from .star import GOLD_ORDER, build_star


@query("check_unique")
def q_check_unique(spark, sf_dir):
    return check_unique(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@query("check_not_null")
def q_check_not_null(spark, sf_dir):
    return check_not_null(silver_t(spark, sf_dir))


@query("check_lengths")
def q_check_lengths(spark, sf_dir):
    return check_lengths(silver_t(spark, sf_dir), SILVER_LENGTHS)


@query("dim_lengths")
def q_dim_lengths(spark, sf_dir):
    """Declared lengths of the dimensions' text columns."""
    star, out = star_t(spark, sf_dir), None
    for name, limits in DIM_LENGTHS.items():
        part = check_lengths(star[name], limits).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("check_orphans")
def q_check_orphans(spark, sf_dir):
    """The full star's child keys against dimensions loaded from finished orders only."""
    silver = silver_snapshot(spark, sf_dir)
    children = build_star(silver)
    parents = build_star(silver.where(F.col("treatment_outcome_status") == "F"))
    return check_all_orphans(children, parents, FOREIGN_KEYS)


def _counts(frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """(step, n): one count per frame."""
    out = None
    for step, df in frames:
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    """The reference rule: all silver rows vs all rows of the built table."""
    silver = silver_snapshot(spark, sf_dir)
    star = build_star(silver)
    built = _counts([(name, star[name]) for name in GOLD_ORDER])
    total = silver.agg(F.count(F.lit(1)).alias("source_count"))  # one row, counted once
    both = built.crossJoin(F.broadcast(total))
    return both.select("step", "source_count", F.col("n").alias("destination_count"),
                       reconcile_col(F.col("source_count"), F.col("n")).alias("reconciliation_status"))


def _run_gold(spark, sf_dir) -> str:
    """The gold build over T into a scratch warehouse; returns the tracker path."""
    tracker_path = scratch_path(spark, "tracker")
    fixed = dt.datetime(2024, 1, 1)
    tracker = Tracker(spark, tracker_path, "run-0001", clock=lambda: fixed)
    build_gold(spark, silver_t(spark, sf_dir), scratch_path(spark, "gold"), tracker)
    return tracker_path


@query("star_reconciliation")
def q_star_reconciliation(spark, sf_dir):
    t = spark.read.schema(TRACKER_SCHEMA).parquet(_run_gold(spark, sf_dir))
    return t.where(F.col("status") == "SUCCESS").select(
        "step", "source_count", "destination_count", "reconciliation_status")


@query("tracker_rows")
def q_tracker_rows(spark, sf_dir):
    t = spark.read.schema(TRACKER_SCHEMA).parquet(_run_gold(spark, sf_dir))
    return t.select("seq", "step", "source_layer", "destination_layer", "status", "source_count",
                    "destination_count", "reconciliation_status")


@query("tracker_latest")
def q_tracker_latest(spark, sf_dir):
    t = spark.read.schema(TRACKER_SCHEMA).parquet(_run_gold(spark, sf_dir))
    return latest_status(t).select("step", "status", "source_count", "destination_count",
                                   "reconciliation_status")

