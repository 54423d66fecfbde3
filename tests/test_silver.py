"""Flatten, safe casts, rejects, combination ids and the id registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from treatment_lake.operators import silver as sv
from treatment_lake.operators.combos import add_combo_ids, combo_ids, registry_update
from treatment_lake.schemas import COMBO_ID

from .conftest import rows


def test_safe_casts_and_rejects(spark):
    df = spark.createDataFrame(
        [("1", "abc", "2.7", "2024-13-01", "1.005", "12345.67"),
         ("2", "10.00", "5", "2024-01-02 03:04:05", "2.5", "1.00"),
         (None, None, None, None, None, None)],
        "treatment_id string, treatment_cost string, patient_age string, treatment_start_date string, "
        "disease_mortality_rate string, provider_full_name string")
    typed = sv.cast_types(df)
    got = {r["treatment_id"]: r for r in typed.collect()}
    assert got[1]["treatment_cost"] is None and got[1]["patient_age"] is None
    assert got[1]["treatment_start_date"] is None
    assert str(got[1]["disease_mortality_rate"]) == "1.01"  # half-up rounding to scale 2
    assert str(got[2]["treatment_cost"]) == "10.00" and got[2]["patient_age"] == 5
    rej = dict(rows(sv.cast_rejects(df)))
    assert rej["treatment_cost"] == 1 and rej["patient_age"] == 1 and rej["treatment_start_date"] == 1
    assert rej["treatment_id"] == 0 and rej["provider_full_name"] == 0


def test_combo_ids_in_label_order(spark):
    df = spark.createDataFrame(
        [("Surgery", "Ongoing"), ("Surgery", "Ongoing"), ("Drug", "Cured"), (None, "Cured"), (None, None)],
        "treatment_type string, treatment_outcome_status string")
    ids = {(r[0], r[1]): r[COMBO_ID] for r in combo_ids(df).collect()}
    # labels: '' (both NULL) < 'Cured' < 'Drug_Cured' < 'Surgery_Ongoing'
    assert ids == {(None, None): 1, (None, "Cured"): 2, ("Drug", "Cured"): 3, ("Surgery", "Ongoing"): 4}
    out = add_combo_ids(df)
    assert out.where(F.col(COMBO_ID).isNull()).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_registry_keeps_known_ids(spark):
    first = spark.createDataFrame([("B", "x"), ("C", "x")], "treatment_type string, treatment_outcome_status string")
    later = spark.createDataFrame([("A", "x"), ("C", "x"), ("D", "x")],
                                  "treatment_type string, treatment_outcome_status string")
    reg1 = combo_ids(first)
    reg2 = registry_update(reg1, later)
    ids = {r["treatment_type"]: r[COMBO_ID] for r in reg2.collect()}
    # B, C keep 1, 2; new pairs A, D are numbered after them in label order.
    assert ids == {"B": 1, "C": 2, "A": 3, "D": 4}
    # Applying the same batch again changes nothing.
    reg3 = registry_update(reg2, later)
    assert rows(reg3) == rows(reg2)


def test_pairs_with_one_label_get_their_own_ids_either_way(spark):
    schema = "treatment_type string, treatment_outcome_status string"
    pairs = [("a_b", "c"), ("a", "b_c")]
    full = {(r[0], r[1]): r[COMBO_ID] for r in combo_ids(spark.createDataFrame(pairs, schema)).collect()}
    assert full == {("a", "b_c"): 1, ("a_b", "c"): 2}
    one = combo_ids(spark.createDataFrame(pairs[1:], schema))
    both = {(r[0], r[1]): r[COMBO_ID] for r in registry_update(one, spark.createDataFrame(pairs, schema)).collect()}
    assert both == full


def test_combo_registry_has_a_bound(spark, monkeypatch):
    import pytest

    from treatment_lake.operators import combos

    monkeypatch.setattr(combos, "MAX_COMBOS", 1)
    with pytest.raises(ValueError):
        add_combo_ids(spark.createDataFrame([("a", "x"), ("b", "x")], "treatment_type string, treatment_outcome_status string"))
