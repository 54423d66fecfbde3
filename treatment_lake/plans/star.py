"""Silver -> star schema (eight dimensions + fact), as lazy frames.

``build_star`` gives the *source* rows of every gold table from one silver
frame (full mode: the merge into an empty target is the source itself).
``plans.gold`` merges them into stored tables, with tracking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.dims import DIM_BUILDERS
from ..operators.fact import fact_rows
from ..schemas import COMBO_ID

# Build order of the gold steps (dimensions first, then the fact).
GOLD_ORDER = (
    "dim_dates", "dim_times", "dim_treatment_types_and_outcome_statuses", "dim_locations",
    "dim_specialities", "dim_providers", "dim_patients", "dim_diseases", "fact_treatments",
)


def build_star(silver: DataFrame, time_source: DataFrame | None = None,
               time_cols: list[str] | None = None) -> dict[str, DataFrame]:
    """All nine gold source frames from ``silver``.

    ``time_source``/``time_cols`` let the time dimension read other
    timestamps (e.g. event times) when silver's are all midnight.
    """
    star = {name: DIM_BUILDERS[name](silver) for name in GOLD_ORDER if name != "fact_treatments"
            and (COMBO_ID in silver.columns or name != "dim_treatment_types_and_outcome_statuses")}
    if time_source is not None:
        star["dim_times"] = DIM_BUILDERS["dim_times"](time_source, time_cols or ["ts"])
    star["fact_treatments"] = fact_rows(silver)
    return star
