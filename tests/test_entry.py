"""Driver contract: entry smoke, registry/oracle coverage, oracle parity on sf0.001."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from treatment_lake.sources.tables import DRIVER_TABLES

from .conftest import SMOKE_DIR


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["provider_id", "provider_full_name", "total_treatments", "success_rate"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from treatment_lake.plans.oracle_sql import ORACLE
    from treatment_lake.plans.queries import QUERIES

    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if v.__class__.__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


SAMPLE = ["provider_success_rate_rank", "monthly_trends", "geo_distribution", "avg_cost_per_provider",
          "dim_dates", "silver_treatments", "cast_rejects", "type_outcome_registry", "latest_per_key",
          "null_safe_join", "check_orphans", "upsert_type1", "incremental_lookback", "epoch_seconds", "mart_order",
          "monthly_trends_by_role", "pipeline_rejects", "upsert_late_version", "latest_file_mtime", "empty_export", "layer_reset"]


@pytest.mark.parametrize("key", SAMPLE)
def test_oracle_parity(spark, duck, key):
    sdf = E.queries()[key](spark, SMOKE_DIR)
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(dcols, res.fetchall())
