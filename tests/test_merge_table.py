"""Merges that cost what the batch costs: parts, lookups, feed, recovery, incremental marts."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatment_lake.operators.fact import fact_versions
from treatment_lake.operators.mart_deltas import partials_of, partials_table, refresh
from treatment_lake.operators.marts import build_marts
from treatment_lake.operators.merge_table import BLOOM, MergeTable, settings
from treatment_lake.plans.gold import build_gold, gold_tables, read_mart, write_marts
from treatment_lake.plans.registry import silver_t
from treatment_lake.plans.star import build_star
from treatment_lake.schemas import WATERMARK_COLUMN
from treatment_lake.session import scratch_path

from .conftest import SMOKE_DIR, rows

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
KV = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
KMV = T.StructType([T.StructField("k", T.LongType()), T.StructField("m", T.IntegerType()), T.StructField("v", T.StringType())])


def files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/data/_part=*/*.parquet")}


def test_merge_is_independent_of_order_and_repetition(spark, scratch):
    schema = f"k long, v string, {WATERMARK_COLUMN} timestamp_ntz"
    batches = [[(1, "old", D1), (2, "x", D2)], [(1, "new", D2), (3, "n", None)], [(2, "y", D2), (3, "m", D1), (None, "z", D2)]]
    frames = [spark.createDataFrame(b, schema) for b in batches]
    for order in ([0, 1, 2], [2, 1, 0, 1, 2]):
        t = MergeTable(spark, scratch("merge"), KV, ["k"], version=WATERMARK_COLUMN, buckets=3)
        counts = [t.merge(frames[i]) for i in order]
        assert rows(t.read()) == [(1, "new"), (2, "y"), (3, "m")], order
        assert [(c.source_rows, c.written_keys) for c in counts] == [(2, 2)] * len(order)
        assert t.last() == len(order)


def test_source_or_target_wins_without_a_version(spark, scratch):
    first, second = spark.createDataFrame([(1, "a"), (2, "b")], KV), spark.createDataFrame([(2, "c"), (3, "a")], KV)
    for insert_only, two in ((False, "c"), (True, "b")):
        t = MergeTable(spark, scratch("plain"), KV, ["k"], insert_only=insert_only)
        assert t.read().collect() == []
        t.merge(first), t.merge(second)
        assert rows(t.read()) == [(1, "a"), (2, two), (3, "a")]
    empty = MergeTable(spark, scratch("empty"), KV, ["k"])
    assert empty.merge(first.limit(0)).source_rows == 0 and empty.read().collect() == []
    empty.merge(first), empty.merge(first.limit(0))
    assert rows(empty.read()) == [(1, "a"), (2, "b")]


def test_a_small_batch_leaves_the_other_parts_files_untouched(spark, scratch):
    root = scratch("hash")
    t = MergeTable(spark, root, KV, ["k"], buckets=32)
    t.merge(spark.range(5000).selectExpr("id AS k", "'old' AS v"))
    before = files(root)
    merged = t.merge(spark.range(10).selectExpr("id * 400 AS k", "'new' AS v"))
    after = files(root)
    changed = {f.split("_part=")[1].split("/")[0] for f in before if f not in after or after[f] != before[f]}
    assert changed == {str(p) for p in merged.touched} and 0 < len(changed) <= 10
    assert len(glob.glob(f"{root}/data/_part=*")) == 32
    assert t.read().where("v = 'new'").count() == 10 and t.read().count() == 5000
    # the number of parts belongs to the table: another default does not deal keys anew
    again = MergeTable(spark, root, KV, ["k"], buckets=5)
    again.merge(spark.range(10).selectExpr("id * 400 AS k", "'newer' AS v"))
    assert again.count() == 5000 and len(glob.glob(f"{root}/data/_part=*")) == 32


def test_merge_touches_only_its_parts_and_moves_rows(spark, scratch):
    root = scratch("parts")
    t = MergeTable(spark, root, KMV, ["k"], part=F.col("m"), visible="m IS NOT NULL")
    frame = lambda data: spark.createDataFrame(data, KMV)
    t.merge(frame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 5, "d")]))
    before = files(root)
    # key 3 moves from part 2 to 3 (part 2 becomes empty); key 1 changes in place; part 5 is not written again
    for _ in range(2):
        t.merge(frame([(3, 3, "c2"), (1, 1, "a2")]))
        assert rows(t.read()) == [(1, 1, "a2"), (2, 1, "b"), (3, 3, "c2"), (4, 5, "d")]
    after = files(root)
    kept = [f for f in before if f in after and after[f] == before[f]]
    assert len(kept) == 1 and "_part=5" in kept[0] and not os.path.exists(f"{root}/data/_part=2")
    # a row that loses its part is hidden, and gone from the part it was in
    t.merge(frame([(4, None, "d")]))
    assert [r[0] for r in rows(t.read())] == [1, 2, 3] and t.read_stored().count() == 4


def test_the_lookup_of_old_rows_filters_at_the_scan(spark, scratch):
    t = MergeTable(spark, scratch("lookup"), KMV, ["k"], part=F.col("m"))
    t.merge(spark.range(20_000).selectExpr("id AS k", "CAST(id % 3 AS INT) AS m", "'v' AS v"))
    src = scratch("src")
    spark.range(9_000, 9_050).selectExpr("id AS k", "9 AS m", "'w' AS v").write.parquet(src)
    found = t.found(t._rows(), spark.read.schema(KMV).parquet(src), 9_000, 9_049)
    with settings(spark, {**BLOOM, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 50
    assert "might_contain" in plan and "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,9000), LessThanOrEqual(k,9049)" in plan


def test_a_merge_that_stopped_is_finished_by_the_next_use(spark, scratch, monkeypatch):
    root = scratch("stop")
    t = MergeTable(spark, root, KMV, ["k"], part=F.col("m"))
    frame = lambda data: spark.createDataFrame(data, KMV)
    t.merge(frame([(1, 1, "a"), (2, 2, "b")]))

    def stop(self, number, entry):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(MergeTable, "_apply", stop)
        with pytest.raises(KeyboardInterrupt):
            t.merge(frame([(2, 3, "moved"), (4, 1, "new")]))
    other = MergeTable(spark, root, KMV, ["k"], part=F.col("m"))
    assert rows(other.read()) == [(1, 1, "a"), (2, 3, "moved"), (4, 1, "new")] and other.last() == 2
    # one that failed before its log entry counts for nothing
    with monkeypatch.context() as m:
        m.setattr(MergeTable, "_note", stop)
        with pytest.raises(KeyboardInterrupt):
            other.merge(frame([(9, 9, "x")]))
    assert other.count() == 3
    other.merge(frame([(9, 9, "y")]))
    assert other.count() == 4 and other.last() == 3


def test_feed_holds_what_changed(spark, scratch):
    t = MergeTable(spark, scratch("feed"), KMV, ["k"], part=F.col("m"), visible="m IS NOT NULL", feed=True)
    frame = lambda data: spark.createDataFrame(data, KMV)
    t.merge(frame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")]))
    assert t.changes(0) is None and t.changes(1).collect() == []
    t.merge(frame([(1, 1, "a"), (2, 4, "b2"), (3, None, "c"), (5, 1, "e")]))
    assert rows(t.changes(1)) == [(-1, 2, 1, "b"), (-1, 3, 2, "c"), (1, 2, 4, "b2"), (1, 5, 1, "e")]
    t.merge(frame([(5, 1, "e")]))  # nothing new
    assert t.changes(2).collect() == [] and t.changes(1).count() == 4
    t.forget_changes(2)
    assert t.changes(1) is None and t.changes(2).collect() == []


def _batches(spark):
    """Silver in three batches: every second treatment in an old version, their true versions, the rest with old versions that come late."""
    path = scratch_path(spark, "silver")
    silver_t(spark, SMOKE_DIR).write.parquet(path)
    silver = spark.read.parquet(path)
    older = silver.withColumns({WATERMARK_COLUMN: F.col(WATERMARK_COLUMN) - F.expr("INTERVAL 9 DAYS"), "treatment_cost": F.col("treatment_cost") + 1,
                                "provider_id": F.col("provider_id") % 3 + 1, "treatment_start_date": F.col("treatment_start_date") - F.expr("INTERVAL 40 DAYS"),
                                "treatment_type_and_outcome_status_id": F.lit(1)})
    even = F.col("treatment_id") % 2 == 0
    return silver, [older.where(even), silver.where(even), silver.where(~even).unionByName(older.where(F.col("treatment_id") % 4 == 2))]


def test_marts_after_batches_equal_a_rebuild_without_reading_the_fact(spark, scratch, monkeypatch):
    silver, batches = _batches(spark)
    gold, marts, again = scratch("gold"), scratch("marts"), scratch("again")
    reads = []
    how = []
    for batch in batches:
        tables = build_gold(spark, batch, gold, silver_is_stored=True)
        with monkeypatch.context() as m:
            m.setattr(MergeTable, "read_stored", lambda self, f=MergeTable.read_stored: (reads.append((len(how), self.root)), f(self))[1])
            how.append(write_marts(spark, tables, marts))
    assert how == ["rebuilt", "delta", "delta"]
    assert [n for n, root in reads if root.endswith("fact_treatments")] == [0]
    want = build_marts(build_star(silver))
    for name in ("provider_treatment_rank", "provider_success_rate_rank", "monthly_treatment_trends", "geographical_treatment_distribution",
                 "summary_avg_treatment_cost", "summary_total_treatments_per_city", "summary_provider_success_rates"):
        assert rows(read_mart(spark, marts, name)) == rows(want[name]), name
    write_marts(spark, gold_tables(spark, gold), again, rebuild=True)
    assert rows(read_mart(spark, again, "monthly_treatment_trends")) == rows(want["monthly_treatment_trends"])
    # nothing new: the sums stay
    assert write_marts(spark, gold_tables(spark, gold), marts) == "current"


def test_partials_are_rebuilt_when_the_feed_has_a_gap(spark, scratch):
    _, batches = _batches(spark)
    partials, fact = partials_table(spark, scratch("partials")), gold_tables(spark, scratch("gold"))["fact_treatments"]
    for i, batch in enumerate(batches):
        fact.merge(fact_versions(batch))
        if i == 0:
            assert refresh(fact, partials) == "rebuilt"
        if i == 1:
            fact.forget_changes(fact.last())
    assert refresh(fact, partials) == "rebuilt" and refresh(fact, partials) == "current"
    assert rows(partials.read().drop("upto")) == rows(partials_of(fact.read()))
