"""Query registry and the shared inputs of the named queries.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame. The
input of most is "T": the treatment records the adapter derives from the
driver tables, so every query's work grows with those tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import silver as sv
from ..operators.combos import add_combo_ids
from ..operators.merge_table import settings
from ..operators.sinks import write_table
from ..session import SHUFFLES_GO, scratch_path
from ..sources.adapter import flat_records
from ..sources.tables import Tables
from .star import build_star

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def flat_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T's 30 flattened typed columns."""
    return flat_records(Tables(spark, sf_dir))


def silver_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: 31-column silver records derived from the driver tables (once: the pairs come from the stored rows)."""
    return silver_snapshot(spark, sf_dir)


def measured_broadcasts(spark: SparkSession) -> dict[str, str]:
    """Settings under which a table is broadcast by its measured size only. An estimate from file sizes takes a million short
    keys, which pack well, for a small table; the driver then builds its hash table."""
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    measured = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or most
    return {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": measured}


def flat_snapshot(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """T without ids written once as a table in the shared folder: queries that
    derive several frames from T scan it, so each source table is read once and
    their lineage starts at the files. With ``columns`` only those are derived and
    written; the others are NULL, for frames that are never asked for them (T has one
    row per treatment, so no tie is decided by them)."""
    rows = flat_t(spark, sf_dir)
    path = scratch_path(spark, "flat-snapshot")
    with settings(spark, measured_broadcasts(spark) | SHUFFLES_GO):
        write_table(rows.select(*[c for c in rows.columns if columns is None or c in columns]), path)
    return spark.read.schema(rows.schema).parquet(path)


def silver_snapshot(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """T with ids over the snapshot: the ids are a broadcast join on its scan."""
    return add_combo_ids(flat_snapshot(spark, sf_dir, columns))


def bronze_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T as bronze rows (tagged groups), built in-query."""
    return sv.bronze_from_items(sv.items_from_flat(flat_t(spark, sf_dir)), "t")


def star_t(spark: SparkSession, sf_dir: str, with_ids: bool = True, columns: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The star over one snapshot of T (of the given columns); without ids there is no combination dimension."""
    return build_star(silver_snapshot(spark, sf_dir, columns) if with_ids else flat_snapshot(spark, sf_dir, columns))
