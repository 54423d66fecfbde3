"""What a stream of arrivals moves and keeps on disk: packed rows, one stored copy of a batch, no shuffle files of ended queries."""

from __future__ import annotations

import copy
import glob
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatment_lake.functions.tags import BRONZE_SCHEMA, packed_groups, unpacked_groups
from treatment_lake.operators import silver as sv
from treatment_lake.plans.registry import flat_snapshot, flat_t
from treatment_lake.schemas import ITEM_GROUPS
from treatment_lake.session import checkpoint_root
from treatment_lake.sources import items, layers
from treatment_lake.streaming.arrivals import arrivals, stream_bronze

from .conftest import SMOKE_DIR, rows

ODD_VALUES = [{"S": "a\u0001b"}, {"S": "\u0002"}, {"S": ""}, {"N": ""}, {"S": "{x"}, {"S": 'a\\"\né\U0001f600'}, {"NULL": True}, {"NULL": False}, {}, None,
              {"S": "a", "N": "1"}, {"S": "a", "NULL": True}, {"BOOL": True}, {"SS": ["a", "b"]}, {"NS": ["1"]}, {"B": "YQ=="}, {"BS": ["YQ=="]},
              {"L": [{"S": "x"}]}, {"M": {"k": {"N": "7"}}}, {"S": None}, {"N": 12.50}, {"Q": 1}]


def _usual(spark, scratch, n: int) -> list[dict]:
    path = scratch("items")
    items.write_items(flat_t(spark, SMOKE_DIR).orderBy("treatment_id").limit(n), path)
    return [json.loads(r["value"]) for r in spark.read.text(path).collect()]


def _odd_lines(usual: list[dict]) -> list[str]:
    out = list(usual)

    def changed(change) -> None:
        out.append(copy.deepcopy(usual[0]))
        change(out[-1]["Item"])

    for v in ODD_VALUES:
        for g, f in (("treatment", "id"), ("disease", "name"), ("metadata", "added_at")):
            changed(lambda item: item[g]["M"].update({f: v}))
    for g in ITEM_GROUPS:
        m = usual[1]["Item"][g]["M"]
        for v in (None, {"M": {}}, {"M": None}, {"S": "x"}, {"S": "x", "M": m}, {"M": dict(reversed(m.items()))}, {"M": m | {"note": {"S": "n"}}}):
            changed(lambda item: item.update({g: v}))
        changed(lambda item: item.pop(g))
    changed(lambda item: item.update(insurance={"M": {"plan": {"N": "7"}}}))
    return [json.dumps(x) for x in out] + ['{"Item":{"treatment":{"M":{"id":{"N":"1"},"id":{"N":"2"}}}}}', '{"Item":{}}']


@pytest.fixture
def odd_lines(spark, scratch):
    path = scratch("odd") + "/e1"
    spark.createDataFrame([(x,) for x in _odd_lines(_usual(spark, scratch, 30))], "value string").coalesce(1).write.text(path)
    return path


def _bronze(spark, path):
    return sv.bronze_from_items(items.read_items(spark, path).where(items.is_item()))


def test_packed_rows_come_back_as_they_were(spark, odd_lines):
    bronze = _bronze(spark, odd_lines).withColumn("k", F.monotonically_increasing_id())
    packed = packed_groups(bronze, "p")
    back = unpacked_groups(packed, "p")
    assert back.columns == bronze.columns
    assert [f.dataType.simpleString() for f in back.schema] == [f.dataType.simpleString() for f in bronze.schema]
    want, got = ([str(r) for r in d.orderBy("k").collect()] for d in (bronze, back))
    assert len(want) > 100 and got == want
    kinds = [(r["short"], r["n"]) for r in packed.groupBy((~F.col("p").startswith("{")).alias("short")).agg(F.count("*").alias("n")).collect()]
    assert dict(kinds)[True] >= 30 and dict(kinds)[False] >= 50  # usual items, and others


def test_arrivals_move_packed_rows(spark, odd_lines):
    moved = arrivals(spark, odd_lines, "30 days")
    assert not [f.name for f in moved.schema if isinstance(f.dataType, (T.MapType, T.StructType))]  # maps of tags take several KB a row
    usual = _bronze(spark, odd_lines).limit(30)
    sizes = packed_groups(usual.withColumn("text", F.to_json(F.struct(*ITEM_GROUPS))), "p").agg(F.sum(F.length("p")), F.sum(F.length("text"))).first()
    assert sizes[0] < 0.5 * sizes[1]


def test_a_batch_is_stored_once_and_its_copy_goes(spark, scratch, odd_lines, monkeypatch):
    bronze, kept = scratch("bronze"), spark.sparkContext._jsc.getPersistentRDDs
    with open(f"{odd_lines}/bad.txt", "w") as f:
        f.write("broken\nbroken\n")
    before, seen, read_run = kept().size(), [], layers.read_run

    def watched(df, run):
        seen.append((kept().size(), len(glob.glob(f"{checkpoint_root(spark)}/arrived-*"))))
        return read_run(df, run)

    monkeypatch.setattr(layers, "read_run", watched)
    got = stream_bronze(spark, odd_lines, bronze, scratch("ckpt"), delay="30 days", timeout_s=300)
    assert set(seen) == {(before, 1)} and glob.glob(f"{checkpoint_root(spark)}/arrived-*") == []
    want = _bronze(spark, odd_lines)
    text = [F.to_json(F.struct(*ITEM_GROUPS, "rescued"))]
    assert sum(b["refused_lines"] for b in got) == 1
    assert set(rows(layers.read_layer(spark, bronze, BRONZE_SCHEMA), *text)) == set(rows(want, *text))


def _shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(i).getName() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_with_their_query(spark, scratch):
    path = scratch("landing")
    items.write_items(flat_t(spark, SMOKE_DIR).limit(50), f"{path}/e1")
    before = _shuffle_files(spark)
    flat_snapshot(spark, SMOKE_DIR)
    stream_bronze(spark, f"{path}/*", scratch("bronze"), scratch("ckpt"), timeout_s=300)
    assert _shuffle_files(spark) - before == set()
