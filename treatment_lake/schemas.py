"""Table definitions: silver, the star schema, the tracker.

Everything here is data: column names, types, keys, declared lengths and
foreign keys. Builders elsewhere select columns by these names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the source system's layout) -----------------
# Document groups and their fields, in document order. A flattened column is
# named "<group>_<field>". The silver table is these 30 columns followed by
# the type/outcome combination id.
ITEM_GROUPS: dict[str, list[str]] = {
    "treatment": ["id", "start_date", "completion_date", "outcome_status", "outcome_date",
                  "duration_in_days", "cost", "type"],
    "provider": ["id", "full_name", "speciality_id", "speciality_name", "affiliated_hospital"],
    "location": ["id", "country", "state", "city"],
    "patient": ["id", "full_name", "gender", "age"],
    "disease": ["id", "speciality_id", "name", "type", "severity", "transmission_mode",
                "mortality_rate"],
    "metadata": ["added_at", "modified_at"],
}
# The item key that is not a group and is dropped on unwrap.
PARTITION_KEY_ATTR = "treatment_id_partition_key"
# Declared VARCHAR lengths of the warehouse tables (silver and dims).
SILVER_LENGTHS: dict[str, int] = {
    "treatment_outcome_status": 50, "treatment_type": 50,
    "provider_full_name": 255, "provider_speciality_name": 255, "provider_affiliated_hospital": 255,
    "location_country": 100, "location_state": 100, "location_city": 100,
    "patient_full_name": 255, "patient_gender": 255,
    "disease_name": 255, "disease_type": 100, "disease_severity": 50,
    "disease_transmission_mode": 100,
}
DIM_LENGTHS: dict[str, dict[str, int]] = {
    "dim_dates": {"day_of_week": 10, "month": 10},
    "dim_treatment_types_and_outcome_statuses": {"treatment_type": 50, "treatment_outcome_status": 50},
    "dim_locations": {"country": 100, "state": 100, "city": 100},
    "dim_specialities": {"speciality_name": 255},
    "dim_providers": {"full_name": 255, "affiliated_hospital": 255},
    "dim_patients": {"full_name": 255, "gender": 10},
    "dim_diseases": {"name": 255, "type": 100, "severity": 50, "transmission_mode": 100},
}
COMBO_ID = "treatment_type_and_outcome_status_id"

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 2)

SILVER_TYPES: dict[str, T.DataType] = {
    "treatment_id": T.LongType(),
    "treatment_start_date": T.TimestampNTZType(),
    "treatment_completion_date": T.TimestampNTZType(),
    "treatment_outcome_status": T.StringType(),
    "treatment_outcome_date": T.TimestampNTZType(),
    "treatment_duration_in_days": T.IntegerType(),
    "treatment_cost": MONEY,
    "treatment_type": T.StringType(),
    "provider_id": T.LongType(),
    "provider_full_name": T.StringType(),
    "provider_speciality_id": T.LongType(),
    "provider_speciality_name": T.StringType(),
    "provider_affiliated_hospital": T.StringType(),
    "location_id": T.LongType(),
    "location_country": T.StringType(),
    "location_state": T.StringType(),
    "location_city": T.StringType(),
    "patient_id": T.LongType(),
    "patient_full_name": T.StringType(),
    "patient_gender": T.StringType(),
    "patient_age": T.IntegerType(),
    "disease_id": T.LongType(),
    "disease_speciality_id": T.LongType(),
    "disease_name": T.StringType(),
    "disease_type": T.StringType(),
    "disease_severity": T.StringType(),
    "disease_transmission_mode": T.StringType(),
    "disease_mortality_rate": RATE,
    "metadata_added_at": T.TimestampNTZType(),
    "metadata_modified_at": T.TimestampNTZType(),
    COMBO_ID: T.IntegerType(),
}

# ---------------------------------------------------------------------------

FLAT_COLUMNS: list[str] = [f"{g}_{f}" for g, fields in ITEM_GROUPS.items() for f in fields]
SILVER_COLUMNS: list[str] = FLAT_COLUMNS + [COMBO_ID]
assert SILVER_COLUMNS == list(SILVER_TYPES)

SILVER_NOT_NULL = ["treatment_id", "treatment_start_date", "provider_id", "location_id",
                   "patient_id", "disease_id"]
TIMESTAMP_COLUMNS = ["treatment_start_date", "treatment_completion_date", "treatment_outcome_date",
                     "metadata_added_at", "metadata_modified_at"]
WATERMARK_COLUMN = "metadata_modified_at"


def silver_schema() -> T.StructType:
    return T.StructType([
        T.StructField(c, t, c not in SILVER_NOT_NULL) for c, t in SILVER_TYPES.items()
    ])


def struct_of(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


# --- Fixed values: names, types and keys of the warehouse tables -----------
DIM_SCHEMAS: dict[str, T.StructType] = {
    "dim_dates": struct_of([
        ("date_sk", T.IntegerType()), ("date", T.DateType()), ("day_of_week", T.StringType()),
        ("month", T.StringType()), ("quarter", T.IntegerType()), ("year", T.IntegerType()),
        ("is_weekend", T.BooleanType())]),
    "dim_times": struct_of([
        ("time_sk", T.IntegerType()), ("hours", T.IntegerType()), ("minutes", T.IntegerType()),
        ("seconds", T.IntegerType())]),
    "dim_treatment_types_and_outcome_statuses": struct_of([
        ("treatment_type_and_outcome_status_sk", T.IntegerType()),
        ("treatment_type", T.StringType()), ("treatment_outcome_status", T.StringType())]),
    "dim_locations": struct_of([
        ("location_sk", T.LongType()), ("country", T.StringType()), ("state", T.StringType()),
        ("city", T.StringType())]),
    "dim_specialities": struct_of([("speciality_sk", T.LongType()), ("speciality_name", T.StringType())]),
    "dim_providers": struct_of([
        ("provider_sk", T.LongType()), ("full_name", T.StringType()), ("speciality_sk", T.LongType()),
        ("affiliated_hospital", T.StringType()), ("location_sk", T.LongType())]),
    "dim_patients": struct_of([
        ("patient_sk", T.LongType()), ("full_name", T.StringType()), ("gender", T.StringType()),
        ("age", T.IntegerType())]),
    "dim_diseases": struct_of([
        ("disease_sk", T.LongType()), ("speciality_sk", T.LongType()), ("name", T.StringType()),
        ("type", T.StringType()), ("severity", T.StringType()), ("transmission_mode", T.StringType()),
        ("mortality_rate", RATE)]),
}

FACT_SCHEMA = struct_of([
    ("fact_treatment_sk", T.LongType()),
    ("treatment_type_and_outcome_status_sk", T.IntegerType()),
    ("provider_sk", T.LongType()), ("location_sk", T.LongType()), ("patient_sk", T.LongType()),
    ("disease_sk", T.LongType()), ("speciality_sk", T.LongType()),
    ("start_date_sk", T.IntegerType()), ("completion_date_sk", T.IntegerType()),
    ("outcome_date_sk", T.IntegerType()),
    ("start_time_sk", T.IntegerType()), ("completion_time_sk", T.IntegerType()),
    ("outcome_time_sk", T.IntegerType()),
    ("duration_in_days", T.IntegerType()), ("cost", MONEY),
])

# Primary keys of every gold table (and silver).
PRIMARY_KEYS: dict[str, list[str]] = {
    "silver": ["treatment_id"],
    "dim_dates": ["date_sk"],
    "dim_times": ["time_sk"],
    "dim_treatment_types_and_outcome_statuses": ["treatment_type_and_outcome_status_sk"],
    "dim_locations": ["location_sk"],
    "dim_specialities": ["speciality_sk"],
    "dim_providers": ["provider_sk"],
    "dim_patients": ["patient_sk"],
    "dim_diseases": ["disease_sk"],
    "fact_treatments": ["fact_treatment_sk"],
}

# Declared foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("dim_providers", "speciality_sk", "dim_specialities", "speciality_sk"),
    ("dim_providers", "location_sk", "dim_locations", "location_sk"),
    ("dim_diseases", "speciality_sk", "dim_specialities", "speciality_sk"),
    ("fact_treatments", "treatment_type_and_outcome_status_sk",
     "dim_treatment_types_and_outcome_statuses", "treatment_type_and_outcome_status_sk"),
    ("fact_treatments", "provider_sk", "dim_providers", "provider_sk"),
    ("fact_treatments", "location_sk", "dim_locations", "location_sk"),
    ("fact_treatments", "patient_sk", "dim_patients", "patient_sk"),
    ("fact_treatments", "disease_sk", "dim_diseases", "disease_sk"),
    ("fact_treatments", "speciality_sk", "dim_specialities", "speciality_sk"),
    ("fact_treatments", "start_date_sk", "dim_dates", "date_sk"),
    ("fact_treatments", "completion_date_sk", "dim_dates", "date_sk"),
    ("fact_treatments", "outcome_date_sk", "dim_dates", "date_sk"),
    ("fact_treatments", "start_time_sk", "dim_times", "time_sk"),
    ("fact_treatments", "completion_time_sk", "dim_times", "time_sk"),
    ("fact_treatments", "outcome_time_sk", "dim_times", "time_sk"),
]
# ---------------------------------------------------------------------------

TRACKER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("step", T.StringType(), False),
    T.StructField("source_layer", T.StringType(), False),
    T.StructField("destination_layer", T.StringType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("destination_table", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("source_count", T.LongType(), True),
    T.StructField("destination_count", T.LongType(), True),
    T.StructField("reconciliation_status", T.StringType(), True),
    T.StructField("completion_timestamp", T.TimestampNTZType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])
