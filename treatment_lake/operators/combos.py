"""Treatment type / outcome status combination ids.

Full mode: the distinct pairs numbered in the order (label, type, status),
where the label is ``type_status`` (``concat_ws``, NULL parts skipped): two
pairs with one label get two ids, as they do one by one. The pairs are
written as a small registry table first; its size is checked against
``MAX_COMBOS`` and it is broadcast, so no row of the input is shuffled for
its id.

Incremental mode: ids already given stay; new pairs get ``max(id) +
row_number`` in the same order, so a batch never relabels an existing pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import COMBO_ID
from ..session import scratch_path
from .sinks import write_table

TYPE_COL = "treatment_type"
STATUS_COL = "treatment_outcome_status"
REGISTRY_SCHEMA = f"{TYPE_COL} string, {STATUS_COL} string, combo string, {COMBO_ID} int"
# Pairs are a small domain; free text in these columns is an error in the source, not a domain.
MAX_COMBOS = 100_000


def combo_label(type_col: str = TYPE_COL, status_col: str = STATUS_COL) -> F.Column:
    return F.concat_ws("_", F.col(type_col), F.col(status_col))


def _order() -> list[F.Column]:
    return [F.col(c).asc_nulls_last() for c in ("combo", TYPE_COL, STATUS_COL)]


def distinct_combos(df: DataFrame) -> DataFrame:
    return df.select(TYPE_COL, STATUS_COL).distinct().withColumn("combo", combo_label())


def combo_ids(df: DataFrame) -> DataFrame:
    """(treatment_type, treatment_outcome_status, combo, id) for every pair present."""
    return distinct_combos(df).withColumn(COMBO_ID, F.row_number().over(Window.orderBy(*_order())).cast("int"))


def checked_registry(registry: DataFrame) -> DataFrame:
    """A stored registry, broadcast after a check of its size."""
    n = registry.count()
    if n > MAX_COMBOS:
        raise ValueError(f"{n} combinations of type and status; at most {MAX_COMBOS} are expected")
    return F.broadcast(registry)


def _join_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.select(F.col(TYPE_COL).alias("_t"), F.col(STATUS_COL).alias("_s"), F.col(COMBO_ID).alias("_id"))
    cond = F.col(TYPE_COL).eqNullSafe(F.col("_t")) & F.col(STATUS_COL).eqNullSafe(F.col("_s"))
    cols = [c for c in df.columns if c != COMBO_ID]
    return df.join(checked_registry(ids), cond, "left").select(*cols, F.col("_id").alias(COMBO_ID))


def add_combo_ids(df: DataFrame) -> DataFrame:
    """Append the combination id column (full-mode numbering)."""
    spark = df.sparkSession
    path = scratch_path(spark, "combos")
    write_table(combo_ids(df), path)
    return _join_ids(df, spark.read.schema(REGISTRY_SCHEMA).parquet(path))


def registry_update(registry: DataFrame | None, df: DataFrame) -> DataFrame:
    """Registry (type, status, combo, id) extended by the pairs of ``df`` it lacks."""
    seen = distinct_combos(df)
    if registry is None:
        return combo_ids(df)
    reg = registry.select(TYPE_COL, STATUS_COL, "combo", COMBO_ID)
    cond = (seen[TYPE_COL].eqNullSafe(reg[TYPE_COL]) & seen[STATUS_COL].eqNullSafe(reg[STATUS_COL]))
    new = (seen.join(reg, cond, "left_anti")
           .withColumn(COMBO_ID, F.lit(None).cast("int")).withColumn("_new", F.lit(1)))
    both = reg.withColumn("_new", F.lit(0)).unionByName(new)
    # Both windows run over the distinct pairs only (known plus new).
    top = F.coalesce(F.max(COMBO_ID).over(Window.partitionBy()), F.lit(0))
    rn = F.row_number().over(Window.partitionBy("_new").orderBy(*_order()))
    return both.select(TYPE_COL, STATUS_COL, "combo",
                       F.coalesce(F.col(COMBO_ID), top + rn).cast("int").alias(COMBO_ID))


def assign_with_registry(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Append ids from a stored registry that already covers every pair of ``df``."""
    return _join_ids(df, registry)
