"""Layouts that later reads can use: buckets, interleaved keys; one scan of each source."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from treatment_lake.functions.interleave import interleaved, quantile_bounds, value_rank
from treatment_lake.operators import marts
from treatment_lake.operators import silver as sv
from treatment_lake.operators.merge_table import settings
from treatment_lake.operators.sinks import write_layout
from treatment_lake.plans.registry import bronze_t, silver_t
from treatment_lake.plans.queries_arrivals import bucketed_star
from treatment_lake.sources import layers

from .conftest import SMOKE_DIR, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    fact, providers, _ = bucketed_star(spark, SMOKE_DIR)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rank = marts.provider_treatment_rank(fact, providers, ordered=False)
        plan = plan_of(rank)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = rows(rank)
    assert got == rows(fact.join(providers, "provider_sk").groupBy("provider_sk", "full_name").count())


def _groups_read(path, column, lo, hi):
    """(row groups whose statistics meet the range, all row groups), from the footers."""
    met = every = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            every += 1
            met += stats.min <= hi and stats.max >= lo
    return met, every


def test_either_key_of_an_interleaved_layout_prunes(spark, scratch):
    df = spark.range(64_000).select(F.pmod(F.xxhash64("id"), F.lit(100_003)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(99_991)).alias("b"), "id")
    zorder, ranged = scratch("z"), scratch("r")
    write_layout(df, zorder, interleave=["a", "b"], num_partitions=64)
    write_layout(df, ranged, range_by=["a", "b"], num_partitions=64)
    for column in ("a", "b"):
        met, every = _groups_read(zorder, column, 50_000, 52_000)
        assert every >= 60 and met <= 0.4 * every, (column, met, every)  # the range bounds are sampled, so cells are not exact squares
    assert _groups_read(ranged, "b", 50_000, 52_000)[0] > 60  # a lexicographic order prunes by its first key only
    assert rows(layers.read_layer(spark, zorder, df.schema).where("b BETWEEN 50000 AND 52000")) == rows(df.where("b BETWEEN 50000 AND 52000"))


def test_value_ranks_and_interleaved_bits(spark):
    df = spark.createDataFrame([(float(x), None if x % 7 == 0 else x) for x in range(1000)], "a double, b int")
    bounds = quantile_bounds(df, ["a", "b"], 4)
    assert all(len(v) == 15 and v == sorted(v) for v in bounds.values())
    out = df.select("a", "b", value_rank(F.col("a"), bounds["a"]).alias("r"), value_rank(F.col("b"), bounds["b"]).alias("s"),
                    interleaved([value_rank(F.col(c), bounds[c]) for c in ("a", "b")], 4).alias("z")).collect()
    for r in out:
        assert r.r == sum(x <= r.a for x in bounds["a"]) and r.s == (0 if r.b is None else sum(x <= r.b for x in bounds["b"]))
        assert r.z == sum(((r.r >> i) & 1) << (2 * i + 1) | ((r.s >> i) & 1) << (2 * i) for i in range(4))
    assert value_rank(F.col("a"), []) is not None and quantile_bounds(df.limit(0), ["a"]) == {"a": []}
    with pytest.raises(ValueError):
        interleaved([F.lit(1)] * 8, 8)


def test_each_source_is_read_once(spark, monkeypatch):
    """T is derived into a stored table once; what is returned reads that table and no source."""
    from treatment_lake.sources.tables import Tables

    reads = []
    monkeypatch.setattr(Tables, "__getattr__", lambda self, name, f=Tables.__getattr__: (reads.append(name), f(self, name))[1])
    for make in (lambda: silver_t(spark, SMOKE_DIR), lambda: sv.to_silver(bronze_t(spark, SMOKE_DIR))):
        reads.clear()
        out = make()
        assert sorted(set(reads)) == ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]
        assert not any(SMOKE_DIR in f for f in out.inputFiles())
        assert out.count() == spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").count()
