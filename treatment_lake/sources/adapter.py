"""Adapter: driver TPC-H-like tables -> flat, typed treatment records.

One record per order. Line items are reduced per order first (a hash
aggregate with map-side combine), so the order join sees one row per key
and reuses the aggregate's hash partitioning on the order key. ``nation``
and ``region`` have a fixed size (25 and 5 rows by the TPC-H definition)
and are broadcast; supplier, part and customer grow with the data and
are left to the planner (AQE picks broadcast only from measured sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FLAT_COLUMNS, MONEY, RATE
from .tables import Tables


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Per order: completion (last ship date), outcome (last returned ship date),
    lowest supplier and part keys."""
    return lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("completion"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("outcome"),
        F.min("l_suppkey").alias("supp"),
        F.min("l_partkey").alias("part"),
    )


def _tag(prefix: str, c) -> F.Column:
    # NULL-propagating concatenation (a NULL part gives NULL).
    return F.concat(F.lit(prefix), c.cast("string"))


def flat_records(t: Tables) -> DataFrame:
    """The 30 flattened, typed silver columns (no combination id yet)."""
    nation = t.nation
    supplier = (t.supplier.join(
        F.broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                  F.col("n_name").alias("s_nation_name"))),
        "s_nationkey", "left"))
    geo = F.broadcast(
        nation.join(F.broadcast(t.region), nation.n_regionkey == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"))
    customer = t.customer.join(geo, "c_nationkey", "inner")

    li = order_lines(t.lineitem.select("l_orderkey", "l_shipdate", "l_returnflag", "l_suppkey",
                                       "l_partkey"))
    o = t.orders
    joined = (
        o.join(li, o.o_orderkey == li.l_orderkey, "left")
        .join(supplier, F.col("supp") == F.col("s_suppkey"), "left")
        .join(t.part, F.col("part") == F.col("p_partkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
    )
    start = F.col("o_orderdate")
    completion = F.col("completion")
    return joined.select(
        F.col("o_orderkey").cast("long").alias("treatment_id"),
        start.alias("treatment_start_date"),
        completion.alias("treatment_completion_date"),
        F.col("o_orderstatus").alias("treatment_outcome_status"),
        F.col("outcome").alias("treatment_outcome_date"),
        F.datediff(F.to_date(completion), F.to_date(start)).cast("int").alias("treatment_duration_in_days"),
        F.col("o_totalprice").cast(MONEY).alias("treatment_cost"),
        F.col("o_orderpriority").alias("treatment_type"),
        F.col("supp").cast("long").alias("provider_id"),
        F.col("s_name").alias("provider_full_name"),
        F.col("s_nationkey").cast("long").alias("provider_speciality_id"),
        F.col("s_nation_name").alias("provider_speciality_name"),
        _tag("HOSPITAL_", F.col("s_suppkey") % 10).alias("provider_affiliated_hospital"),
        F.col("c_nationkey").cast("long").alias("location_id"),
        F.col("r_name").alias("location_country"),
        F.col("n_name").alias("location_state"),
        _tag("CITY_", F.col("c_nationkey") % 10).alias("location_city"),
        F.col("c_custkey").cast("long").alias("patient_id"),
        F.col("c_name").alias("patient_full_name"),
        F.col("c_mktsegment").alias("patient_gender"),
        (F.col("c_custkey") % 90).cast("int").alias("patient_age"),
        F.col("part").cast("long").alias("disease_id"),
        (F.col("p_partkey") % 25).cast("long").alias("disease_speciality_id"),
        F.col("p_name").alias("disease_name"),
        F.col("p_type").alias("disease_type"),
        F.col("p_brand").alias("disease_severity"),
        _tag("MODE_", F.col("p_size") % 5).alias("disease_transmission_mode"),
        F.col("p_size").cast(RATE).alias("disease_mortality_rate"),
        start.alias("metadata_added_at"),
        F.coalesce(completion, start).alias("metadata_modified_at"),
    ).select(*FLAT_COLUMNS)
