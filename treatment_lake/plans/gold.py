"""Silver -> gold (P4) and gold -> marts.

``build_gold`` merges the nine gold tables from one silver frame (full
table or the runs gold has not committed), in the fixed order, each step
tracked and reconciled. A step's source is derived once; the merge counts its rows
with a key and how many of those keys it wrote while it writes them
(``MergeTable``), so neither source nor target is read again to reconcile. A failed
step raises, so no later step runs on a half-built star.

Dimensions and the fact are stored with the version of each row, and the
newest version of a key wins: the order in which batches arrive does not matter,
and a batch merged twice changes nothing. Dimensions take every version in
silver, so a key that only a superseded version had is in the dimension either way.

The marts come from partial sums that each merge's changes are added to
(``mart_deltas``); ``rebuild`` makes them from the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import DIM_BUILDERS, DIM_MAPPINGS, versioned_dim
from ..operators.fact import fact_versions
from ..operators.mart_deltas import marts_from_partials, partials_table, refresh
from ..operators.marts import FIRST, build_marts
from ..operators.merge_table import MergeTable
from ..operators.sinks import write_table
from ..operators.tracker import Tracker
from ..operators.upsert import RunTable
from ..schemas import DIM_SCHEMAS, FACT_SCHEMA, PRIMARY_KEYS, WATERMARK_COLUMN
from ..session import scratch_path
from .star import GOLD_ORDER

INSERT_ONLY = ("dim_dates", "dim_times")
#: dimensions that grow with the data, in hash parts; the others have one part
GROWING = ("dim_providers", "dim_patients", "dim_diseases")


def gold_tables(spark: SparkSession, gold_root: str, buckets: int = 16) -> dict[str, MergeTable]:
    """Growing dimensions in parts by a hash of the key; the fact by start month (yyyymm), so a merge rewrites only the
    months it touches. A treatment whose newest version has no start date stays in part 0, hidden, to replace older rows.
    ``buckets`` counts for tables that are made now."""
    tables = {n: MergeTable(spark, f"{gold_root}/{n}", DIM_SCHEMAS[n], PRIMARY_KEYS[n], None if n in INSERT_ONLY else WATERMARK_COLUMN,
                            buckets=buckets if n in GROWING else 1, insert_only=n in INSERT_ONLY)
              for n in GOLD_ORDER if n != "fact_treatments"}
    tables["fact_treatments"] = MergeTable(spark, f"{gold_root}/fact_treatments", FACT_SCHEMA, PRIMARY_KEYS["fact_treatments"],
                                           WATERMARK_COLUMN, part=(F.col("start_date_sk") / 100).cast("int"),
                                           visible="start_date_sk IS NOT NULL", feed=True)
    return tables


def gold_source(name: str, silver: DataFrame, time_source: DataFrame | None = None, time_cols: list[str] | None = None) -> DataFrame:
    """The rows that a step merges, with their version where the table keeps one."""
    if name == "fact_treatments":
        return fact_versions(silver)
    if name in DIM_MAPPINGS:
        return versioned_dim(silver, name)
    if name == "dim_times" and time_source is not None:
        return DIM_BUILDERS[name](time_source, time_cols or ["ts"])
    return DIM_BUILDERS[name](silver)


def _staged(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(spark, name)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path), path


def build_gold(spark: SparkSession, silver: DataFrame, gold_root: str, tracker: Tracker | None = None,
               time_source: DataFrame | None = None, time_cols: list[str] | None = None,
               silver_name: str = "silver", silver_is_stored: bool = False) -> dict[str, MergeTable]:
    """``silver_is_stored``: ``silver`` is a scan of a table; otherwise it is written once, for the nine steps."""
    tables, staged = gold_tables(spark, gold_root), None
    try:
        if not silver_is_stored:
            silver, staged = _staged(spark, silver, "gold-silver")
        for name in GOLD_ORDER:
            step = (name, "silver", "gold", silver_name, name)
            if tracker:
                tracker.started(*step)
            try:
                merged = tables[name].merge(gold_source(name, silver, time_source, time_cols))
            except Exception:
                if tracker:
                    tracker.failed(*step)
                raise
            if tracker:
                tracker.finished(*step, merged.source_rows, merged.written_keys)
    finally:
        if staged:
            _remove(spark, staged)
    return tables


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_marts(spark: SparkSession, tables: dict[str, MergeTable], mart_root: str,
                success_ids: Sequence[int] | str = FIRST, success_statuses: Sequence[str] | None = None,
                tracker: Tracker | None = None, rebuild: bool = False) -> str:
    """All seven marts from the partial sums, which take in what the merges since the last time changed (``rebuild``:
    from the fact). Rows are counted as they are written and again from the written files. Returns how the sums were
    brought up to date."""
    star = {n: t.read() for n, t in tables.items() if n != "fact_treatments"}
    how = "rebuilt"
    if rebuild:
        made = build_marts({**star, "fact_treatments": tables["fact_treatments"].read()}, success_ids, success_statuses)
    else:
        partials = partials_table(spark, f"{mart_root}/partials")
        how = refresh(tables["fact_treatments"], partials)
        made = marts_from_partials(partials.read(), star, success_ids, success_statuses)
    for name, df in made.items():
        table = RunTable(spark, f"{mart_root}/{name}", df.schema)
        step = (name, "gold", "mart", "fact_treatments", name)
        if tracker:
            tracker.started(*step)
        try:
            seen = Observation()
            table.replace(df.observe(seen, F.count(F.lit(1)).alias("n")))
        except Exception:
            if tracker:
                tracker.failed(*step)
            raise
        if tracker:
            tracker.finished(*step, seen.get["n"], table.count())
    return how


def read_mart(spark: SparkSession, mart_root: str, name: str) -> DataFrame:
    table = RunTable(spark, f"{mart_root}/{name}", None)
    run = table.current()
    if run is None:
        raise FileNotFoundError(f"mart {name} has no committed run under {mart_root}")
    return spark.read.parquet(f"{table.root}/runs/{run}")
