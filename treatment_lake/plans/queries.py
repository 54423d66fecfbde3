"""Named queries: marts, star tables and the silver path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import GROUP, unwrap_group
from ..operators import dims, marts
from ..operators import silver as sv
from ..operators.combos import combo_ids, combo_label, registry_update
from ..operators.ranking import with_position
from ..schemas import FLAT_COLUMNS, TIMESTAMP_COLUMNS, WATERMARK_COLUMN
from ..session import scratch_path
from ..sources.items import read_items, write_items
from ..sources.tables import Tables
from .registry import QUERIES, QueryFn, bronze_t, flat_snapshot, flat_t, query, silver_t, star_t
from .star import build_star

# --- marts (E1-E7, F5) ------------------------------------------------------

#: the columns of T that a mart needs: those of a fact row's identity, of its pair, provider and place
ROW_COLUMNS = ["treatment_id", "treatment_start_date", WATERMARK_COLUMN]
PAIR_COLUMNS = ["treatment_type", "treatment_outcome_status"]
PROVIDER_COLUMNS = ROW_COLUMNS + list(dims.DIM_MAPPINGS["dim_providers"])
PLACE_COLUMNS = ROW_COLUMNS + list(dims.DIM_MAPPINGS["dim_locations"])
COMBOS = "dim_treatment_types_and_outcome_statuses"


@query("provider_treatment_rank")
def q_provider_treatment_rank(spark, sf_dir):
    s = star_t(spark, sf_dir, False, PROVIDER_COLUMNS)
    return marts.provider_treatment_rank(s["fact_treatments"], s["dim_providers"])


@query("provider_success_rate_rank")
def q_provider_success_rate_rank(spark, sf_dir):
    s = star_t(spark, sf_dir, True, PROVIDER_COLUMNS + PAIR_COLUMNS)
    return marts.provider_success_rate_rank(s["fact_treatments"], s["dim_providers"], s[COMBOS])


@query("provider_success_rates")
def q_provider_success_rates(spark, sf_dir):
    s = star_t(spark, sf_dir, True, PROVIDER_COLUMNS + PAIR_COLUMNS)
    return marts.provider_success_rates(s["fact_treatments"], s["dim_providers"], s[COMBOS])


@query("provider_rank_with_position")
def q_provider_rank_with_position(spark, sf_dir):
    s = star_t(spark, sf_dir, True, PROVIDER_COLUMNS + PAIR_COLUMNS)
    return marts.provider_rank_with_position(s["fact_treatments"], s["dim_providers"], s[COMBOS])


@query("monthly_trends")
def q_monthly_trends(spark, sf_dir):
    s = star_t(spark, sf_dir, True, ROW_COLUMNS + PAIR_COLUMNS + TIMESTAMP_COLUMNS)
    return marts.monthly_trends(s["fact_treatments"], s["dim_dates"], s[COMBOS])


@query("geo_distribution")
def q_geo_distribution(spark, sf_dir):
    s = star_t(spark, sf_dir, False, PLACE_COLUMNS)
    return marts.geo_distribution(s["fact_treatments"], s["dim_locations"])


@query("treatments_per_city")
def q_treatments_per_city(spark, sf_dir):
    s = star_t(spark, sf_dir, False, PLACE_COLUMNS)
    return marts.treatments_per_city(s["fact_treatments"], s["dim_locations"])


@query("avg_cost_per_provider")
def q_avg_cost_per_provider(spark, sf_dir):
    s = star_t(spark, sf_dir, False, PROVIDER_COLUMNS + ["treatment_cost"])
    return marts.avg_cost_per_provider(s["fact_treatments"], s["dim_providers"])


# --- dimensions and fact (D1-D9) ---------------------------------------------

def _star_table(name: str) -> QueryFn:
    """One star table straight from T; only two of them need the combination ids."""
    def fn(spark, sf_dir):
        if name in ("dim_treatment_types_and_outcome_statuses", "fact_treatments"):
            return build_star(silver_t(spark, sf_dir))[name]
        return build_star(flat_t(spark, sf_dir))[name]
    fn.__name__ = f"q_{name}"
    return fn


for _key, _table in [
    ("dim_dates", "dim_dates"),
    ("dim_type_outcome", "dim_treatment_types_and_outcome_statuses"),
    ("dim_locations", "dim_locations"),
    ("dim_specialities", "dim_specialities"),
    ("dim_providers", "dim_providers"),
    ("dim_patients", "dim_patients"),
    ("dim_diseases", "dim_diseases"),
    ("fact_treatments", "fact_treatments"),
]:
    QUERIES[_key] = _star_table(_table)


@query("monthly_trends_by_role")
def q_monthly_trends_by_role(spark, sf_dir):
    """E3 for each of the fact's three date roles."""
    s = star_t(spark, sf_dir, True, ROW_COLUMNS + PAIR_COLUMNS + TIMESTAMP_COLUMNS)
    out = None
    for role in ("start", "completion", "outcome"):
        part = marts.monthly_trends(s["fact_treatments"], s["dim_dates"], s[COMBOS], ordered=False, date_role=role).withColumn("date_role", F.lit(role))
        out = part if out is None else out.unionByName(part)
    return out


@query("mart_order_full")
def q_mart_order_full(spark, sf_dir):
    """Every row's position in E1 (one sort key and the id) and in E3 (two sort keys)."""
    s = star_t(spark, sf_dir, True, PROVIDER_COLUMNS + PAIR_COLUMNS + TIMESTAMP_COLUMNS)
    e1 = with_position(spark, marts.provider_treatment_rank(s["fact_treatments"], s["dim_providers"], ordered=False),
                       [F.col("total_treatments").desc_nulls_last(), F.col("provider_id").asc_nulls_last()])
    e3 = with_position(spark, marts.monthly_trends(s["fact_treatments"], s["dim_dates"], s[COMBOS], ordered=False),
                       [F.col("year").desc_nulls_last(), F.col("month").desc_nulls_last()])
    return e1.select(F.lit("provider_treatment_rank").alias("mart"), "position", F.col("provider_id").cast("string").alias("label")).unionByName(
        e3.select(F.lit("monthly_trends").alias("mart"), "position", F.concat_ws(" ", F.col("year").cast("string"), "month").alias("label")))


@query("mart_order")
def q_mart_order(spark, sf_dir):
    """The first twenty positions of each mart, as its SQL twin asks; ``mart_order_full`` has them all."""
    return q_mart_order_full(spark, sf_dir).where("position <= 20").withColumn("position", F.col("position").cast("int"))


# --- silver path (A1, A4, B1-B3, U1-U2, I11-I16, F3-F4, Q5, P1) -------------

def _text_columns(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


@query("unwrap_items")
def q_unwrap_items(spark, sf_dir):
    u = sv.unwrap_items(bronze_t(spark, sf_dir))
    return u.select(F.col("treatment")["id"].alias("treatment_id"),
                    F.col("treatment")["type"].alias("treatment_type"),
                    F.col("treatment")["outcome_status"].alias("treatment_outcome_status"),
                    F.col("treatment")["cost"].alias("treatment_cost"),
                    F.col("treatment")["completion_date"].alias("treatment_completion_date"))


@query("scan_items")
def q_scan_items(spark, sf_dir):
    path = scratch_path(spark, "items")
    write_items(flat_t(spark, sf_dir), path)
    b = sv.bronze_from_items(read_items(spark, path), "scan")
    u = sv.unwrap_items(b)
    return u.select(F.col("treatment")["id"].alias("treatment_id"),
                    F.col("treatment")["type"].alias("treatment_type"),
                    F.col("treatment")["outcome_status"].alias("treatment_outcome_status"),
                    F.col("treatment")["cost"].alias("treatment_cost"),
                    F.col("provider")["id"].alias("provider_id"),
                    F.col("metadata")["modified_at"].alias("metadata_modified_at"))


@query("unwrap_nested")
def q_unwrap_nested(spark, sf_dir):
    """events.props re-encoded as a nested M value and as an L list, parsed with
    the fixed value schema and unwrapped natively."""
    ev = Tables(spark, sf_dir).events.select("event_id", "props")
    k = F.get_json_object("props", "$.k")
    line = F.concat(F.lit('{"props_m":{"M":{"k":{"N":"'), k, F.lit('"}}},"props_l":{"L":[{"N":"'), k,
                    F.lit('"}]}}'))
    u = ev.select("event_id", F.from_json(line, GROUP).alias("parsed")).select("event_id", unwrap_group("parsed").alias("g"))
    return u.select("event_id",
                    F.get_json_object(F.col("g")["props_m"], "$.k").alias("k"),
                    F.get_json_object(F.col("g")["props_l"], "$[0]").alias("k_from_list"))


@query("flatten_items")
def q_flatten_items(spark, sf_dir):
    return sv.flatten_items(sv.unwrap_items(bronze_t(spark, sf_dir)))


def text_with_bad_values(spark, sf_dir) -> DataFrame:
    """T's 30 columns as text, with unparsable values planted on data-defined rows."""
    t = _text_columns(flat_t(spark, sf_dir), FLAT_COLUMNS)
    status, typ, seg = F.col("treatment_outcome_status"), F.col("treatment_type"), F.col("patient_gender")
    return t.select(
        *[F.col(c) for c in FLAT_COLUMNS if c not in (
            "treatment_cost", "treatment_start_date", "disease_mortality_rate", "patient_age",
            "treatment_duration_in_days")],
        F.when(status == "P", F.lit("abc")).otherwise(F.col("treatment_cost")).alias("treatment_cost"),
        F.when((typ == "1-URGENT") & (status == "P"), F.lit("2024-13-01"))
        .otherwise(F.col("treatment_start_date")).alias("treatment_start_date"),
        F.when(seg == "BUILDING", F.lit("12345.67")).otherwise(F.col("disease_mortality_rate"))
        .alias("disease_mortality_rate"),
        F.when(seg == "MACHINERY", F.lit("x7")).otherwise(F.col("patient_age")).alias("patient_age"),
        F.when(typ == "5-LOW", F.lit("99999999999")).otherwise(F.col("treatment_duration_in_days"))
        .alias("treatment_duration_in_days"),
    ).select(*FLAT_COLUMNS)


@query("cast_types")
def q_cast_types(spark, sf_dir):
    return sv.cast_types(text_with_bad_values(spark, sf_dir))


@query("safe_casts")
def q_safe_casts(spark, sf_dir):
    typed = sv.cast_types(text_with_bad_values(spark, sf_dir))
    return typed.select("treatment_id", "treatment_cost", "treatment_start_date", "patient_age",
                        "disease_mortality_rate", "treatment_duration_in_days")


@query("cast_rejects")
def q_cast_rejects(spark, sf_dir):
    return sv.cast_rejects(text_with_bad_values(spark, sf_dir))


@query("type_outcome_ids")
def q_type_outcome_ids(spark, sf_dir):
    return combo_ids(flat_t(spark, sf_dir))


@query("combo_label")
def q_combo_label(spark, sf_dir):
    return flat_t(spark, sf_dir).select("treatment_id", combo_label().alias("combo"))


@query("type_outcome_registry")
def q_type_outcome_registry(spark, sf_dir):
    """Ids of a first batch (finished and open orders), then the whole table arrives."""
    flat = flat_snapshot(spark, sf_dir, PAIR_COLUMNS)
    first = combo_ids(flat.where(F.col("treatment_outcome_status").isin("F", "O")))
    return registry_update(first, flat)


@query("silver_treatments")
def q_silver_treatments(spark, sf_dir):
    return sv.to_silver(bronze_t(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end through stored layers: item export -> bronze -> silver -> gold ->
    marts; returns the provider success-rate ranking mart."""
    from .end_to_end import FIXED_CLOCK, Layout, mart, run_once
    from ..sources.items import write_items

    items = scratch_path(spark, "export")
    write_items(flat_t(spark, sf_dir), items)
    layout = Layout(scratch_path(spark, "lake"))
    run_once(spark, items, layout, run_id="flagship", clock=lambda: FIXED_CLOCK)
    return mart(spark, layout, "provider_success_rate_rank")

