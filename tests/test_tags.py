"""Tag unwrap: every tag, NULL-safe, nested values, item files."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from treatment_lake.functions.tags import GROUP, ITEM_SCHEMA, unwrap_group
from treatment_lake.operators import silver as sv


def _unwrap(spark, group_json: str) -> dict:
    df = spark.createDataFrame([(group_json,)], "j string")
    out = df.select(F.from_json("j", GROUP).alias("g")).select(unwrap_group("g").alias("m")).first()["m"]
    return out


def test_scalar_tags(spark):
    m = _unwrap(spark, json.dumps({
        "a": {"S": "text"}, "b": {"N": "12.50"}, "c": {"BOOL": True}, "d": {"NULL": True},
        "e": {"SS": ["x", "y"]}, "f": {"NS": ["1", "2"]},
    }))
    assert m == {"a": "text", "b": "12.50", "c": "true", "d": None, "e": '["x","y"]', "f": '["1","2"]'}


def test_nested_list_and_map(spark):
    m = _unwrap(spark, json.dumps({
        "l": {"L": [{"S": "a"}, {"N": "1"}, {"NULL": True}]},
        "m": {"M": {"k": {"S": "v"}, "n": {"N": "3"}}},
    }))
    assert json.loads(m["l"]) == ["a", "1", None]
    assert json.loads(m["m"]) == {"k": "v", "n": "3"}


def test_containers_at_any_level(spark):
    deep = {"M": {"items": {"L": [{"M": {"k": {"N": "1"}, "t": {"SS": ["x", 'q"uote']}}}, {"L": [{"L": [{"S": "in"}, {"NULL": True}]}, {"BOOL": False}]}]},
                  "empty": {"M": {}}, "none": {"L": []}, 'na"me': {"B": "eA=="}}}
    m = _unwrap(spark, json.dumps({"d": deep, "s": {"S": '{"M": {"k": {"N": "1"}}}'}}))
    assert json.loads(m["d"]) == {"items": [{"k": "1", "t": ["x", 'q"uote']}, [["in", None], "false"]], "empty": {}, "none": [], 'na"me': "eA=="}
    assert m["s"] == '{"M": {"k": {"N": "1"}}}'  # a text that looks like a value is a text
    # beyond the levels that are compiled, values keep their tags
    from treatment_lake.functions.tags import DEPTH

    value = {"N": "7"}
    for _ in range(DEPTH + 1):
        value = {"L": [value]}
    out = json.loads(_unwrap(spark, json.dumps({"x": value}))["x"])
    for _ in range(DEPTH):
        out = out[0]
    assert out == [{"N": "7"}]


def test_unknown_attributes_are_rescued_and_counted(spark, scratch):
    from treatment_lake.plans.silver_build import extract_to_bronze, rescued
    from treatment_lake.sources.items import is_item, read_items

    lines = [{"Item": {"treatment": {"M": {"id": {"N": "1"}, "note": {"S": "n"}}}, "insurance": {"M": {"plan": {"N": "7"}}}, "treatment_id_partition_key": {"S": "1"}}},
             {"Item": {"treatment": {"M": {"id": {"N": "2"}, "note": {"L": [{"S": "a"}]}}}, "patient": {"S": "no group"}, "disease": {"NULL": True}}},
             {"Item": {"treatment": {"M": {"id": {"N": "3"}}}, "treatment.note": {"S": "a name like another"}}}, {"Item": {"treatment": {"M": {"id": {"N": "4"}}}}}]
    path, bronze = scratch("items"), scratch("bronze")
    spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").write.text(path)
    rows = sv.bronze_from_items(read_items(spark, path).where(is_item())).select(F.col("treatment")["id"]["N"].alias("id"), "rescued").collect()
    kept = {r["id"]: {e["name"]: json.loads(e["value"]) for e in json.loads(r["rescued"])} if r["rescued"] else None for r in rows}
    assert kept == {"1": {"insurance": {"M": {"plan": {"N": "7"}}}, "treatment.note": {"S": "n"}},
                    "2": {"treatment.note": {"L": '[{"S": "a"}]'}, "patient": {"S": "no group"}}, "3": {"treatment.note": {"S": "a name like another"}}, "4": None}
    assert extract_to_bronze(spark, path, bronze)["rescued_rows"] == 3
    assert {r["name"]: r["n"] for r in rescued(spark, bronze).collect()} == {"insurance": 1, "treatment.note": 3, "patient": 1}


def test_field_named_like_a_tag_is_a_field(spark):
    # A document field literally called "S" or "N" is a field, not a tag.
    m = _unwrap(spark, json.dumps({"S": {"N": "5"}, "N": {"S": "five"}}))
    assert m == {"S": "5", "N": "five"}


def test_null_group_and_missing_field(spark):
    df = spark.createDataFrame([(None,)], "j string")
    assert df.select(F.from_json("j", GROUP).alias("g")).select(unwrap_group("g").alias("m")).first()["m"] is None
    bronze = spark.createDataFrame([({"id": {"N": "7"}},)], sv.bronze_from_items(
        spark.createDataFrame([], ITEM_SCHEMA)).select("treatment").schema)
    flat = sv.flatten_items(sv.unwrap_items(bronze))
    r = flat.first()
    assert r["treatment_id"] == "7"
    assert r["treatment_cost"] is None  # missing field
    assert r["provider_id"] is None  # missing group


def test_item_file_roundtrip(spark, scratch):
    from treatment_lake.sources.items import read_items, write_items
    from treatment_lake.schemas import FLAT_COLUMNS, SILVER_TYPES

    values = {c: None for c in FLAT_COLUMNS}
    values.update(treatment_id=1, treatment_type="Surgery", treatment_outcome_status="Ongoing",
                  treatment_cost="120.50", patient_age=40)
    schema = ", ".join(f"{c} string" for c in FLAT_COLUMNS)
    flat = spark.createDataFrame([tuple(str(values[c]) if values[c] is not None else None
                                        for c in FLAT_COLUMNS)], schema)
    flat = flat.select(*[F.col(c).cast(SILVER_TYPES[c]).alias(c) for c in FLAT_COLUMNS])
    path = scratch("items")
    write_items(flat, path)
    line = spark.read.text(path).first()["value"]
    doc = json.loads(line)
    assert doc["Item"]["treatment"]["M"]["id"] == {"N": "1"}
    assert doc["Item"]["treatment"]["M"]["completion_date"] == {"NULL": True}
    silver = sv.to_silver(sv.bronze_from_items(read_items(spark, path)))
    r = silver.first()
    assert r["treatment_id"] == 1 and str(r["treatment_cost"]) == "120.50" and r["patient_age"] == 40
    assert r["treatment_completion_date"] is None and r["treatment_type_and_outcome_status_id"] == 1


def test_silver_plan_has_no_python_udf(spark):
    from treatment_lake.plans.registry import bronze_t

    plan = sv.to_silver(bronze_t(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_fused_flatten_equals_unwrap_then_flatten(spark):
    """``flatten_tagged`` (pick a field, unwrap it) == unwrap every map, then pick."""
    from treatment_lake.functions.tags import BRONZE_SCHEMA

    rows_json = [
        {"treatment": {"id": {"N": "1"}, "type": {"S": "A"}, "cost": {"NULL": True},
                       "outcome_status": {"L": [{"S": "x"}, {"N": "2"}]}},
         "provider": {"id": {"N": "7"}, "full_name": {"M": {"k": {"S": "v"}, "z": {"NULL": True}}}},
         "patient": {"gender": {"SS": ["f", "m"]}, "age": {"BOOL": True}}},
        {"treatment": {"id": {"N": "2"}}, "disease": None},
        {},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows_json], "j string") \
        .select(F.from_json("j", BRONZE_SCHEMA).alias("b")).select("b.*")
    fused = sv.flatten_tagged(df)
    ref = sv.flatten_items(sv.unwrap_items(df))
    assert fused.columns == ref.columns
    assert sorted(map(tuple, fused.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
    assert fused.exceptAll(ref).count() == 0 and ref.exceptAll(fused).count() == 0


def test_binary_tags_and_lines_that_are_no_items(spark, scratch):
    from treatment_lake.sources.items import bad_lines, is_item, read_items

    path = scratch("items")
    lines = ['{"Item": {"treatment": {"M": {"id": {"N": "1"}, "type": {"B": "aGk="}, "outcome_status": {"BS": ["eA==", "eQ=="]}}}}}',
             '{"Item": {"treatment": ', '{}', '[1, 2]']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    items = read_items(spark, path)
    good = sv.flatten_tagged(sv.bronze_from_items(items.where(is_item()))).collect()
    assert [(r["treatment_id"], r["treatment_type"], r["treatment_outcome_status"]) for r in good] == [("1", "aGk=", '["eA==","eQ=="]')]
    assert sorted(r["line"] for r in bad_lines(items).collect()) == sorted(lines[1:])
