"""Bronze -> silver: unwrap, flatten, combination ids, safe casts, rejects.

All steps are native column expressions inside one projection chain, so
the whole transform is a single codegen stage between the scan and the
write (plus the small combination-id side plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tags import RESCUED, RESCUED_TYPE, container_texts, rescued_text, scalar_text, tag_value, unwrap_group, with_containers
from ..schemas import ITEM_GROUPS, PARTITION_KEY_ATTR, SILVER_COLUMNS, SILVER_TYPES
from ..session import scratch_path, wide_rows
from .combos import add_combo_ids
from .merge_table import settings
from .sinks import write_table

# --- items <-> bronze ---------------------------------------------------------


def bronze_from_items(items: DataFrame, run_id: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Strip the outer ``M`` tag of each group. The partition-key attribute is not carried over; what has no column
    (only items read from files can have it) is kept as text in ``rescued``. ``keep``: columns beside the item that stay."""
    cols = [F.col(f"Item.{g}.M").alias(g) for g in ITEM_GROUPS]
    from_files = isinstance(items.schema["Item"].dataType, T.MapType)
    rescued = rescued_text() if from_files else F.lit(None).cast("string")
    return items.select(*cols, rescued.alias(RESCUED), F.lit(run_id).cast("string").alias("ingest_run_id"), *keep)


def rescued_names(bronze: DataFrame) -> DataFrame:
    """``name, n``: the attributes and fields that have no column, and how many items have each."""
    names = F.explode(F.from_json(RESCUED, RESCUED_TYPE)["name"]).alias("name")
    return bronze.where(F.col(RESCUED).isNotNull()).select(names).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def unwrap_items(bronze: DataFrame) -> DataFrame:
    """Every group map -> map<string,string> of plain text values."""
    keep = [c for c in bronze.columns if c not in ITEM_GROUPS and c != PARTITION_KEY_ATTR]
    return bronze.select(*[unwrap_group(g).alias(g) for g in ITEM_GROUPS if g in bronze.columns],
                         *keep)


def flatten_items(unwrapped: DataFrame) -> DataFrame:
    """Groups -> the 30 ``group_field`` text columns; a missing field or group is NULL."""
    cols = []
    for g, fields in ITEM_GROUPS.items():
        for f in fields:
            src = F.col(g)[f] if g in unwrapped.columns else F.lit(None).cast("string")
            cols.append(src.alias(f"{g}_{f}"))
    return unwrapped.select(*cols)


def flatten_tagged(bronze: DataFrame) -> DataFrame:
    """``flatten_items(unwrap_items(bronze))`` without whole maps: each field's
    tagged value is picked from its group map and only that value is
    unwrapped, so no row rebuilds a map through a lambda (higher-order
    functions are evaluated without codegen) unless a field is a container, and
    only groups with a container are handed on as maps."""
    groups = {g: fields for g, fields in ITEM_GROUPS.items() if g in bronze.columns}
    texts = [scalar_text(f"{g}['{f}']").alias(f"{g}_{f}") for g, fields in groups.items() for f in fields]
    rows = bronze.select(*texts, *[with_containers(g, fields).alias(g) for g, fields in groups.items()])
    rows = rows.select(*[f"{g}_{f}" for g, fields in groups.items() for f in fields],
                       *[container_texts(g, fields).alias(f"{g}_containers") for g, fields in groups.items()])
    cols = []
    for g, fields in ITEM_GROUPS.items():
        for f in fields:
            src = F.coalesce(F.col(f"{g}_{f}"), F.col(f"{g}_containers")[f]) if g in groups else F.lit(None).cast("string")
            cols.append(src.alias(f"{g}_{f}"))
    return rows.select(*cols)


def cast_types(flat: DataFrame) -> DataFrame:
    """Text -> silver types with ``try_cast``: a bad value becomes NULL
    (see ``cast_rejects``) instead of failing the job under ANSI mode."""
    out = []
    for c in flat.columns:
        t = SILVER_TYPES.get(c)
        out.append(F.col(c).try_cast(t).alias(c) if t is not None else F.col(c))
    return flat.select(*out)


def cast_rejects(flat_text: DataFrame) -> DataFrame:
    """(column, rejects): values present as text but NULL after the cast. One pass."""
    names = [c for c in flat_text.columns if c in SILVER_TYPES]
    both = flat_text.select(*[F.col(c).alias(f"raw_{c}") for c in names],
                            *[F.col(c).try_cast(SILVER_TYPES[c]).alias(f"typ_{c}") for c in names])
    counts = both.agg(*[F.count_if(F.col(f"raw_{c}").isNotNull() & F.col(f"typ_{c}").isNull()).alias(c)
                        for c in names])
    stack = ", ".join(f"'{c}', `{c}`" for c in names)
    return counts.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, rejects)")


def n_rejects(names: list[str]) -> F.Column:
    """Per row, how many of the text values ``raw_<name>`` fail their cast."""
    return sum((F.when(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull(), 1).otherwise(0) for c in names), F.lit(0))


def cast_with_raw(flat_text: DataFrame) -> DataFrame:
    """The typed columns, the texts they came from (``raw_<name>``) and ``n_rejects``."""
    names = [c for c in flat_text.columns if c in SILVER_TYPES]
    both = flat_text.select(*[F.col(c).try_cast(SILVER_TYPES[c]).alias(c) for c in names], *[F.col(c).alias(f"raw_{c}") for c in names])
    return both.withColumn("n_rejects", n_rejects(names))


def reject_rows(both: DataFrame) -> DataFrame:
    """(treatment_id as text, column_name, value) of every value that failed its cast (of ``cast_with_raw``)."""
    names = [c for c in SILVER_TYPES if f"raw_{c}" in both.columns]
    cells = F.array(*[F.when(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull(),
                             F.struct(F.lit(c).alias("column_name"), F.col(f"raw_{c}").alias("value"))) for c in names])
    # no filter before the explode: pushed down to the scan, it would parse and cast every value once more
    return (both.select(F.col("raw_treatment_id").alias("treatment_id"), F.explode_outer(F.filter(cells, lambda x: x.isNotNull())).alias("r"))
            .where("r IS NOT NULL").select("treatment_id", "r.column_name", "r.value"))


def to_silver(bronze: DataFrame) -> DataFrame:
    """P1: unwrap -> flatten -> combination id -> cast; 31 silver columns.

    The typed rows are written once: the pairs, and then the rows, are read from there, so bronze is parsed once."""
    return add_combo_ids(typed_rows(bronze)).select(*SILVER_COLUMNS)


def typed_rows(bronze: DataFrame) -> DataFrame:
    """The unwrapped, flattened and typed rows, written once."""
    spark, path = bronze.sparkSession, scratch_path(bronze.sparkSession, "typed")
    typed = cast_types(flatten_tagged(bronze))
    with settings(spark, wide_rows(spark)):
        write_table(typed, path)
    return spark.read.schema(typed.schema).parquet(path)


# --- typed rows -> tagged items (to produce item files) -------------------------

_NUMERIC = {"LongType", "IntegerType", "DecimalType"}


def _kind(name: str) -> str:
    return "N" if type(SILVER_TYPES[name]).__name__ in _NUMERIC else "S"


def items_from_flat(flat: DataFrame) -> DataFrame:
    """Typed 30-column rows -> item rows (struct ``Item``) in the document
    encoding: numbers as N, text and timestamps as S, NULL as the NULL tag."""
    groups = []
    for g, fields in ITEM_GROUPS.items():
        kv = []
        for f in fields:
            name = f"{g}_{f}"
            kv += [F.lit(f), tag_value(F.col(name), _kind(name))]
        groups.append(F.struct(F.create_map(*kv).alias("M")).alias(g))
    pk = tag_value(F.col("treatment_id"), "S").alias(PARTITION_KEY_ATTR)
    return flat.select(F.struct(pk, *groups).alias("Item"))


def items_json(flat: DataFrame) -> DataFrame:
    """One JSON text line per item (``value`` column), as an export file holds: the text of ``items_from_flat``, whose NULL
    tags ``to_json`` leaves out, from structs (no map is built, and a value has its own tag and NULL only)."""
    def value(name: str, kind: str) -> F.Column:
        c = F.col(name)
        return F.struct(c.cast("string").alias(kind), F.when(c.isNull(), F.lit(True)).alias("NULL"))

    groups = [F.struct(F.struct(*[value(f"{g}_{f}", _kind(f"{g}_{f}")).alias(f) for f in fields]).alias("M")).alias(g) for g, fields in ITEM_GROUPS.items()]
    return flat.select(F.to_json(F.struct(F.struct(value("treatment_id", "S").alias(PARTITION_KEY_ATTR), *groups).alias("Item"))).alias("value"))
