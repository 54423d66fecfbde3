"""Named queries: calendar and clock functions, date/time dimensions, JSON maps,
the null-safe composite join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar_columns, epoch_seconds, second_of_day, time_columns_from_key
from ..operators.dims import distinct_dates, distinct_times
from ..schemas import TIMESTAMP_COLUMNS
from ..sources.tables import Tables
from .registry import flat_snapshot, flat_t, query


@query("calendar_attributes")
def q_calendar_attributes(spark, sf_dir):
    d = Tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(*calendar_columns("d"))


@query("union_dates")
def q_union_dates(spark, sf_dir):
    return distinct_dates(flat_t(spark, sf_dir))


@query("date_row_numbers")
def q_date_row_numbers(spark, sf_dir):
    """Parity numbering: row_number over the distinct dates (one row per day, so the
    single-partition window sees at most a few thousand rows per decade)."""
    w = Window.orderBy(F.col("date").asc_nulls_last())
    return distinct_dates(flat_t(spark, sf_dir)).select(
        F.row_number().over(w).cast("long").alias("date_row_number"), "date")


def _all_times(spark, sf_dir) -> DataFrame:
    """Seconds of day over silver's five timestamps and the event times."""
    a = distinct_times(flat_t(spark, sf_dir), TIMESTAMP_COLUMNS)
    b = distinct_times(Tables(spark, sf_dir).events, ["ts"])
    return a.unionByName(b).distinct()


@query("time_parts")
def q_time_parts(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id",
                     F.hour("ts").cast("int").alias("hours"),
                     F.minute("ts").cast("int").alias("minutes"),
                     F.second("ts").cast("int").alias("seconds"),
                     second_of_day("ts").alias("second_of_day"),
                     F.to_date("ts").alias("event_date"))


@query("union_times")
def q_union_times(spark, sf_dir):
    return _all_times(spark, sf_dir).select(*time_columns_from_key("k")).drop("time_sk")


@query("time_row_numbers")
def q_time_row_numbers(spark, sf_dir):
    w = Window.orderBy("k")  # at most 86,400 distinct keys
    t = _all_times(spark, sf_dir)
    return t.select(F.row_number().over(w).cast("long").alias("time_row_number"),
                    *time_columns_from_key("k")[1:])


@query("dim_times")
def q_dim_times(spark, sf_dir):
    return _all_times(spark, sf_dir).select(*time_columns_from_key("k"))


@query("epoch_seconds")
def q_epoch_seconds(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", epoch_seconds("o_orderdate").alias("epoch"))


@query("json_map")
def q_json_map(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    m = F.from_json("props", T.MapType(T.StringType(), T.StringType()))
    return ev.select("event_id", m["k"].alias("k"))


@query("null_safe_join")
def q_null_safe_join(spark, sf_dir):
    """Each record joined to the distinct (start, completion, outcome) triples with
    NULL-safe equality (planned as an equi hash join), counted per status;
    a plain equality join would lose every record without an outcome."""
    cols = ["treatment_start_date", "treatment_completion_date", "treatment_outcome_date"]
    t = flat_snapshot(spark, sf_dir, [*cols, "treatment_outcome_status"]).where(F.col("treatment_start_date").isNotNull())
    d = t.select(*[F.col(c).alias(f"d_{c}") for c in cols]).distinct()
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"d_{c}"))
        cond = e if cond is None else cond & e
    j = t.join(d.hint("merge"), cond, "inner")  # the triples grow with the records: never in the driver
    return j.groupBy("treatment_outcome_status").agg(
        F.count(F.lit(1)).alias("n_joined"),
        F.count("treatment_outcome_date").alias("n_with_outcome"))
