"""The seven summary marts and the ranked variant.

Every mart aggregates the fact *before* joining a dimension: the fact is
reduced to one row per dimension key (partial aggregation on the map side,
so a hot key costs one row per map task), and only that reduced set meets
the dimension. As each dimension holds one row per key, the result equals
"join, then group by key and attributes". The inner join still drops fact
rows whose key has no dimension row (and NULL keys).

Success is the combination's outcome status being in ``success_statuses``,
or the combination being the first in label order (``success_ids="first"``,
the default of ``build_marts``: it depends on the pairs, not on the order in
which they arrived), or the combination id being in ``success_ids``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .ranking import with_rank
from .sinks import write_table

COMBO_SK = "treatment_type_and_outcome_status_sk"


FIRST = "first"


def success_combos(dim_combo: DataFrame | None, success_ids=FIRST, success_statuses: Sequence[str] | None = None) -> DataFrame | None:
    """The combination ids that count as success (``_ok_sk``); None: ``explicit_ids`` says it by itself."""
    if success_statuses is None and (success_ids != FIRST or dim_combo is None):
        return None
    if dim_combo is None:
        raise ValueError("success by status needs the type/outcome dimension")
    if success_statuses is not None:
        ok = dim_combo.where(F.col("treatment_outcome_status").isin(list(success_statuses)))
    else:
        label = F.concat_ws("_", "treatment_type", "treatment_outcome_status")
        ok = dim_combo.orderBy(*[c.asc_nulls_last() for c in (label, F.col("treatment_type"), F.col("treatment_outcome_status"))]).limit(1)
    return ok.select(F.col(COMBO_SK).alias("_ok_sk"))


def explicit_ids(success_ids) -> list[int]:
    """Without the dimension the first combination is the one that a full load numbers first."""
    return [1] if success_ids == FIRST else list(success_ids)


def _rate(success: str, total: str) -> F.Column:
    return F.try_divide(F.col(success).cast("double") * F.lit(100.0), F.col(total).cast("double"))


def _counts(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.count("fact_treatment_sk").alias("total_treatments"))


def _success_counts(fact: DataFrame, key: str, dim_combo=None, success_ids=FIRST, success_statuses=None) -> DataFrame:
    """Treatments and successes per key: counted per (key, combination) first, so what meets the combinations is
    that reduced set and not the fact."""
    per = fact.groupBy(key, COMBO_SK).agg(F.count("fact_treatment_sk").alias("n"))
    ok = success_combos(dim_combo, success_ids, success_statuses)
    if ok is None:
        hit = F.coalesce(F.col(COMBO_SK).isin(explicit_ids(success_ids)), F.lit(False))
    else:
        per = per.join(ok, F.col(COMBO_SK) == F.col("_ok_sk"), "left")
        hit = F.col("_ok_sk").isNotNull()
    return per.groupBy(key).agg(F.sum("n").alias("total_treatments"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_success"))


def _with_providers(per_provider: DataFrame, dim_providers: DataFrame) -> DataFrame:
    p = dim_providers.select(F.col("provider_sk").alias("provider_id"),
                             F.col("full_name").alias("provider_full_name"))
    return per_provider.join(p, per_provider.provider_sk == p.provider_id, "inner")


def provider_treatment_rank(fact: DataFrame, dim_providers: DataFrame, ordered: bool = True) -> DataFrame:
    """E1: treatments per provider, most first."""
    j = _with_providers(_counts(fact, "provider_sk"), dim_providers)
    out = j.select("provider_id", "provider_full_name", "total_treatments")
    return out.orderBy(F.desc("total_treatments"), F.asc("provider_id")) if ordered else out


def provider_success_rates(fact: DataFrame, dim_providers: DataFrame, dim_combo: DataFrame | None = None,
                           success_ids: Sequence[int] | str = FIRST, success_statuses=None,
                           ordered: bool = False) -> DataFrame:
    """E7 (unordered) and, with ``ordered=True``, E2: success rate per provider."""
    per = _success_counts(fact, "provider_sk", dim_combo, success_ids, success_statuses)
    j = _with_providers(per, dim_providers)
    out = j.select("provider_id", "provider_full_name", "total_treatments",
                   _rate("n_success", "total_treatments").alias("success_rate"))
    return out.orderBy(F.desc("success_rate"), F.asc("provider_id")) if ordered else out


def provider_success_rate_rank(fact, dim_providers, dim_combo=None, success_ids=FIRST,
                               success_statuses=None) -> DataFrame:
    """E2."""
    return provider_success_rates(fact, dim_providers, dim_combo, success_ids, success_statuses,
                                  ordered=True)


def monthly_trends(fact: DataFrame, dim_dates: DataFrame, dim_combo=None, success_ids=FIRST,
                   success_statuses=None, ordered: bool = True, date_role: str = "start") -> DataFrame:
    """E3: per (year, month name) of the start, completion or outcome date; newest year first, month name descending."""
    day = f"{date_role}_date_sk"
    per_day = _success_counts(fact, day, dim_combo, success_ids, success_statuses)
    d = dim_dates.select("date_sk", "year", "month")
    j = per_day.join(d, per_day[day] == d.date_sk, "inner")
    g = j.groupBy("year", "month").agg(F.sum("total_treatments").alias("total_treatments"),
                                       F.sum("n_success").alias("n_success"))
    out = g.select("year", "month", "total_treatments",
                   _rate("n_success", "total_treatments").alias("success_rate"))
    return out.orderBy(F.desc("year"), F.desc("month")) if ordered else out


def _per_location(fact: DataFrame, dim_locations: DataFrame) -> DataFrame:
    per = fact.groupBy("location_sk").agg(F.count("fact_treatment_sk").alias("n"))
    loc = dim_locations.select(F.col("location_sk").alias("_loc"), "country", "state", "city")
    return per.join(loc, per.location_sk == loc["_loc"], "inner")


def geo_distribution(fact: DataFrame, dim_locations: DataFrame, ordered: bool = True) -> DataFrame:
    """E4: treatments per (country, state, city)."""
    g = _per_location(fact, dim_locations).groupBy("country", "state", "city") \
        .agg(F.sum("n").alias("total_treatments"))
    return g.orderBy(F.desc("total_treatments"), "country", "state", "city") if ordered else g


def treatments_per_city(fact: DataFrame, dim_locations: DataFrame, ordered: bool = True) -> DataFrame:
    """E6: treatments per city name alone (same-named cities merge)."""
    g = _per_location(fact, dim_locations).groupBy("city").agg(F.sum("n").alias("total_treatments"))
    return g.orderBy(F.desc("total_treatments"), "city") if ordered else g


def avg_cost_per_provider(fact: DataFrame, dim_providers: DataFrame) -> DataFrame:
    """E5: average cost per provider, from the exact decimal sum."""
    per = fact.groupBy("provider_sk").agg(F.sum("cost").alias("sum_cost"), F.count("cost").alias("n_cost"))
    j = _with_providers(per, dim_providers)
    avg = F.try_divide(F.col("sum_cost").cast("double"), F.col("n_cost").cast("double"))
    return j.select("provider_id", "provider_full_name", avg.alias("avg_treatment_cost"))


def provider_rank_with_position(fact, dim_providers, dim_combo=None, success_ids=FIRST,
                                success_statuses=None) -> DataFrame:
    """E2 plus rank columns, ``rank()`` by total treatments and
    ``dense_rank()`` by success rate (both descending, NULL last).

    The provider set grows with the data, so the ranks are not a global
    window (one task) but distributed value ranks (``operators/ranking.py``).
    The per-provider rates are written once and both ranks read that table.
    """
    rates = provider_success_rates(fact, dim_providers, dim_combo, success_ids, success_statuses)
    spark = rates.sparkSession
    path = scratch_path(spark, "provider-rates")
    write_table(rates, path)
    rates = spark.read.schema(rates.schema).parquet(path)
    ranked = with_rank(spark, rates, "total_treatments", "treatment_rank")
    ranked = with_rank(spark, ranked, "success_rate", "success_rank", dense=True)
    return ranked.select("provider_id", "provider_full_name", "total_treatments", "success_rate",
                         "treatment_rank", "success_rank")


MART_NAMES = (
    "provider_treatment_rank", "provider_success_rate_rank", "monthly_treatment_trends",
    "geographical_treatment_distribution", "summary_avg_treatment_cost",
    "summary_total_treatments_per_city", "summary_provider_success_rates",
)


def build_marts(star: dict[str, DataFrame], success_ids: Sequence[int] | str = FIRST,
                success_statuses: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """All seven marts from a star (dict of dimension and fact frames)."""
    f = star["fact_treatments"]
    prov = star["dim_providers"]
    combo = star.get("dim_treatment_types_and_outcome_statuses")
    return {
        "provider_treatment_rank": provider_treatment_rank(f, prov),
        "provider_success_rate_rank": provider_success_rate_rank(f, prov, combo, success_ids,
                                                                 success_statuses),
        "monthly_treatment_trends": monthly_trends(f, star["dim_dates"], combo, success_ids,
                                                   success_statuses),
        "geographical_treatment_distribution": geo_distribution(f, star["dim_locations"]),
        "summary_avg_treatment_cost": avg_cost_per_provider(f, prov),
        "summary_total_treatments_per_city": treatments_per_city(f, star["dim_locations"]),
        "summary_provider_success_rates": provider_success_rates(f, prov, combo, success_ids,
                                                                 success_statuses),
    }
