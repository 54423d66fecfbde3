"""Marts kept up to date from what merges changed.

All seven marts are sums over the fact grouped by a provider, a start date or a
location (and the type/outcome combination, for success rates). ``partials_of``
holds those sums in one small table: ``kind, key, combo`` with the number of
treatments, the number of costs and their exact sum. A merge's feed says which
fact rows went (sign -1) and which came (+1); their sums are added to the
partials, so a replaced version is retracted and the new one counted, and the
fact itself is not read. Groups whose count falls to 0 are gone.

The partials remember the number of the last merge they contain. They are written
as a whole to a fresh folder (``RunTable``), so a repeated or interrupted refresh
neither loses nor doubles a change; without a complete feed they are made
from the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONEY
from .marts import COMBO_SK, FIRST, _rate, _with_providers, explicit_ids, success_combos
from .merge_table import MergeTable
from .upsert import RunTable

KEYS = ("kind", "key", "combo")
SUMS = ("n", "n_cost", "sum_cost")
PARTIALS = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("key", T.LongType()), T.StructField("combo", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("n_cost", T.LongType()), T.StructField("sum_cost", T.DecimalType(38, MONEY.scale)),
    T.StructField("upto", T.IntegerType()),
])
KINDS = {"provider": "provider_sk", "date": "start_date_sk", "location": "location_sk"}


def partials_of(fact: DataFrame) -> DataFrame:
    """The sums of fact rows (``sign`` says whether a row counts or is taken back; without it all count)."""
    sign = F.col("sign") if "sign" in fact.columns else F.lit(1)
    groups = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("key"),
                                (F.lit(None).cast("int") if kind == "location" else F.col(COMBO_SK)).alias("combo")) for kind, c in KINDS.items()])
    rows = fact.where("fact_treatment_sk IS NOT NULL").select(sign.cast("long").alias("s"), "cost", F.explode(groups).alias("g"))
    return (rows.select("s", "cost", "g.*").groupBy(*KEYS)
            .agg(F.sum("s").alias("n"), F.sum(F.when(F.col("cost").isNotNull(), F.col("s")).otherwise(0)).alias("n_cost"),
                 F.sum((F.col("s") * F.coalesce(F.col("cost"), F.lit(0))).cast(PARTIALS["sum_cost"].dataType)).alias("sum_cost")))


def added(partials: DataFrame, delta: DataFrame) -> DataFrame:
    both = partials.select(*KEYS, *SUMS).unionByName(delta.select(*KEYS, *SUMS))
    return both.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where("n <> 0 OR n_cost <> 0")


def partials_table(spark: SparkSession, root: str) -> RunTable:
    return RunTable(spark, root, PARTIALS)


def refresh(fact: MergeTable, partials: RunTable) -> str:
    """Brings the partials up to the fact's last merge: ``"current"``, ``"delta"`` or, where the feed does not reach back
    to what the partials contain, ``"rebuilt"``."""
    last = fact.last()
    held = partials.read().agg(F.max("upto").alias("u")).first()["u"] if partials.exists() else None
    if held == last:
        return "current"
    changes = fact.changes(held) if held else None
    rows = added(partials.read(), partials_of(changes)) if changes is not None else partials_of(fact.read())
    partials.replace(rows.withColumn("upto", F.lit(last)))
    fact.forget_changes(last)
    return "delta" if changes is not None else "rebuilt"


def marts_from_partials(partials: DataFrame, star: dict[str, DataFrame], success_ids: Sequence[int] | str = FIRST,
                        success_statuses: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The seven marts; ``star`` needs the dimensions only."""
    prov, dates, loc = star["dim_providers"], star["dim_dates"], star["dim_locations"]
    ok = success_combos(star.get("dim_treatment_types_and_outcome_statuses"), success_ids, success_statuses)

    def of(kind: str, name: str) -> DataFrame:
        return partials.where(F.col("kind") == kind).withColumnRenamed("key", name)

    def rates(kind: str, name: str) -> DataFrame:
        rows = of(kind, name)
        if ok is None:
            hit = F.coalesce(F.col("combo").isin(explicit_ids(success_ids)), F.lit(False))
        else:
            rows, hit = rows.join(ok, F.col("combo") == F.col("_ok_sk"), "left"), F.col("_ok_sk").isNotNull()
        return rows.groupBy(name).agg(F.sum("n").alias("total_treatments"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_success"))

    per_provider = of("provider", "provider_sk").groupBy("provider_sk").agg(*[F.sum(c).alias(c) for c in SUMS])
    names = ("provider_id", "provider_full_name")
    e1 = _with_providers(per_provider.select("provider_sk", F.col("n").alias("total_treatments")), prov).select(*names, "total_treatments")
    cost = F.try_divide(F.col("sum_cost").cast("double"), F.col("n_cost").cast("double")).alias("avg_treatment_cost")
    e5 = _with_providers(per_provider.select("provider_sk", "sum_cost", "n_cost"), prov).select(*names, cost)
    rate = _rate("n_success", "total_treatments").alias("success_rate")
    e7 = _with_providers(rates("provider", "provider_sk"), prov).select(*names, "total_treatments", rate)
    days = rates("date", "date_key").join(dates.select("date_sk", "year", "month"), F.col("date_key") == F.col("date_sk"))
    e3 = (days.groupBy("year", "month").agg(F.sum("total_treatments").alias("total_treatments"), F.sum("n_success").alias("n_success"))
          .select("year", "month", "total_treatments", rate))
    places = of("location", "place").join(loc, F.col("place") == F.col("location_sk"))
    e4 = places.groupBy("country", "state", "city").agg(F.sum("n").alias("total_treatments"))
    e6 = places.groupBy("city").agg(F.sum("n").alias("total_treatments"))
    return {
        "provider_treatment_rank": e1.orderBy(F.desc("total_treatments"), F.asc("provider_id")),
        "provider_success_rate_rank": e7.orderBy(F.desc("success_rate"), F.asc("provider_id")),
        "monthly_treatment_trends": e3.orderBy(F.desc("year"), F.desc("month")),
        "geographical_treatment_distribution": e4.orderBy(F.desc("total_treatments"), "country", "state", "city"),
        "summary_avg_treatment_cost": e5,
        "summary_total_treatments_per_city": e6.orderBy(F.desc("total_treatments"), "city"),
        "summary_provider_success_rates": e7,
    }
