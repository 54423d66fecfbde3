"""The eight dimension builders (silver -> dimension source rows).

Each builder returns one row per key, ready for an upsert. Attribute
dimensions keep the attributes of the key's latest silver row
(``metadata_modified_at``, ties broken by the other columns); a key with
NULL never reaches a dimension.

Dates and times read all five timestamp columns in one scan
(``explode(array(...))``) instead of a five-way UNION of scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, second_of_day, time_columns_from_key
from ..schemas import COMBO_ID, DIM_SCHEMAS, TIMESTAMP_COLUMNS, WATERMARK_COLUMN
from .dedupe import latest_per_key


def distinct_dates(df: DataFrame, cols: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    d = df.select(F.explode(F.array(*[F.to_date(F.col(c)) for c in cols])).alias("date"))
    return d.where(F.col("date").isNotNull()).distinct()


def dim_dates(df: DataFrame, cols: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    return distinct_dates(df, cols).select(*calendar_columns("date"))


def distinct_times(df: DataFrame, cols: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    k = df.select(F.explode(F.array(*[second_of_day(c) for c in cols])).alias("k"))
    return k.where(F.col("k").isNotNull()).distinct()


def dim_times(df: DataFrame, cols: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    """time_sk = second of day; at most 86,400 rows whatever the input size."""
    return distinct_times(df, cols).select(*time_columns_from_key("k"))


def _attribute_dim(silver: DataFrame, name: str, mapping: dict[str, str], with_version: bool = False) -> DataFrame:
    """Latest row per key, renamed silver -> dimension. First mapping entry is the key.

    Equal attribute rows of a key are folded into their newest version first: that is a hash aggregate,
    and the maximum over whole rows (a sort aggregate) sees only what is left."""
    src_cols = list(mapping)
    key = src_cols[0]
    have_wm = WATERMARK_COLUMN in silver.columns
    picked = silver.select(*src_cols, *([WATERMARK_COLUMN] if have_wm else []))
    if have_wm:
        picked = (picked.where(F.col(key).isNotNull()).groupBy(*src_cols)
                  .agg(F.max(WATERMARK_COLUMN).alias(WATERMARK_COLUMN)))
    latest = latest_per_key(picked, [key], [WATERMARK_COLUMN] if have_wm else [])
    schema = DIM_SCHEMAS[name]
    version = [F.col(WATERMARK_COLUMN)] if with_version else []
    return latest.select(*[F.col(s).cast(schema[d].dataType).alias(d) for s, d in mapping.items()], *version)


# Silver column -> dimension column, per dimension (key first).
DIM_MAPPINGS: dict[str, dict[str, str]] = {
    "dim_treatment_types_and_outcome_statuses": {
        COMBO_ID: "treatment_type_and_outcome_status_sk",
        "treatment_type": "treatment_type",
        "treatment_outcome_status": "treatment_outcome_status",
    },
    "dim_locations": {
        "location_id": "location_sk", "location_country": "country",
        "location_state": "state", "location_city": "city",
    },
    "dim_specialities": {
        "provider_speciality_id": "speciality_sk", "provider_speciality_name": "speciality_name",
    },
    "dim_providers": {
        "provider_id": "provider_sk", "provider_full_name": "full_name",
        "provider_speciality_id": "speciality_sk",
        "provider_affiliated_hospital": "affiliated_hospital", "location_id": "location_sk",
    },
    "dim_patients": {
        "patient_id": "patient_sk", "patient_full_name": "full_name",
        "patient_gender": "gender", "patient_age": "age",
    },
    "dim_diseases": {
        "disease_id": "disease_sk", "disease_speciality_id": "speciality_sk",
        "disease_name": "name", "disease_type": "type", "disease_severity": "severity",
        "disease_transmission_mode": "transmission_mode",
        "disease_mortality_rate": "mortality_rate",
    },
}


def versioned_dim(silver: DataFrame, name: str) -> DataFrame:
    """An attribute dimension with the version column that merges compare."""
    return _attribute_dim(silver, name, DIM_MAPPINGS[name], with_version=True)


def dim_type_outcome(silver: DataFrame) -> DataFrame:
    return _attribute_dim(silver, "dim_treatment_types_and_outcome_statuses",
                          DIM_MAPPINGS["dim_treatment_types_and_outcome_statuses"])


def dim_locations(silver: DataFrame) -> DataFrame:
    return _attribute_dim(silver, "dim_locations", DIM_MAPPINGS["dim_locations"])


def dim_specialities(silver: DataFrame) -> DataFrame:
    return _attribute_dim(silver, "dim_specialities", DIM_MAPPINGS["dim_specialities"])


def dim_providers(silver: DataFrame) -> DataFrame:
    return _attribute_dim(silver, "dim_providers", DIM_MAPPINGS["dim_providers"])


def dim_patients(silver: DataFrame) -> DataFrame:
    return _attribute_dim(silver, "dim_patients", DIM_MAPPINGS["dim_patients"])


def dim_diseases(silver: DataFrame) -> DataFrame:
    return _attribute_dim(silver, "dim_diseases", DIM_MAPPINGS["dim_diseases"])


DIM_BUILDERS = {
    "dim_dates": dim_dates,
    "dim_times": dim_times,
    "dim_treatment_types_and_outcome_statuses": dim_type_outcome,
    "dim_locations": dim_locations,
    "dim_specialities": dim_specialities,
    "dim_providers": dim_providers,
    "dim_patients": dim_patients,
    "dim_diseases": dim_diseases,
}
