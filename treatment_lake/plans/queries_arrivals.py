"""Named queries: arrivals (ties, late items, new files, unknown attributes), merges by part, incremental marts,
bucketed tables, interleaved sort."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import GROUP, unwrap_group
from ..operators import marts
from ..operators import silver as sv
from ..operators.merge_table import MergeTable
from ..operators.sinks import write_bucketed, write_layout
from ..operators.tracker import Tracker
from ..schemas import COMBO_ID, TRACKER_SCHEMA, WATERMARK_COLUMN, silver_schema
from ..session import scratch_path
from ..sources import layers
from ..sources.items import write_items, write_lines
from ..sources.tables import Tables
from ..streaming.arrivals import stream_bronze
from .end_to_end import FIXED_CLOCK
from .gold import build_gold, read_mart, write_marts
from .queries import COMBOS, PAIR_COLUMNS, PROVIDER_COLUMNS
from .registry import flat_snapshot, query, silver_snapshot, star_t
from .silver_build import bronze_to_silver, extract_to_bronze, read_files, read_silver, rejects, rescued

TIE = "1996-06-01 00:00:00"
DELAY_DAYS = 30


def _clock():
    return FIXED_CLOCK


def _export(spark, rows: DataFrame, path: str | None = None) -> str:
    path = path or scratch_path(spark, "export")
    write_items(rows, path, mode="append")
    return path


def _upto_tie(flat: DataFrame):
    at = F.col(WATERMARK_COLUMN)
    tie = F.lit(TIE).cast("timestamp_ntz")
    return (at < tie) | ((at == tie) & (F.col("treatment_id") % 2 == 0))


# --- arrivals (S5, S6, A2, P2, A4, A18) ---------------------------------------------


@query("ties_loaded_once")
def q_ties_loaded_once(spark, sf_dir):
    """The second export repeats the watermark's time, with items that the first one had and others."""
    flat = flat_snapshot(spark, sf_dir)
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for run, rows in (("r1", flat.where(_upto_tie(flat))), ("r2", flat)):
        extract_to_bronze(spark, _export(spark, rows), bronze, run, clock=_clock)
        bronze_to_silver(spark, bronze, silver, run)
    return read_silver(spark, silver).groupBy("treatment_id", WATERMARK_COLUMN).agg(F.count(F.lit(1)).alias("n"))


@query("late_rejects")
def q_late_rejects(spark, sf_dir):
    """The second export brings items from long before the watermark: refused, kept and counted, those of the first are not."""
    flat = flat_snapshot(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    extract_to_bronze(spark, _export(spark, flat.where("treatment_id % 10 <> 7")), bronze, "r1", clock=_clock)
    extract_to_bronze(spark, _export(spark, flat), bronze, "r2", clock=_clock)
    return rejects(spark, bronze).select("kind", F.col("treatment_id").cast("long").alias("treatment_id"))


@query("new_files_only")
def q_new_files_only(spark, sf_dir):
    """An export that grows by files, each a folder of parts that several tasks write: what each run reads."""
    flat, bronze, path = flat_snapshot(spark, sf_dir), scratch_path(spark, "bronze"), scratch_path(spark, "export")
    out = []
    parts = ((f"{WATERMARK_COLUMN} < '1997-01-01'", 3), (f"{WATERMARK_COLUMN} >= '1997-01-01'", 2), (None, 0))
    for run, (cond, files) in enumerate(parts):
        if cond:
            rows = flat.where(cond).withColumn("_file", F.pmod(F.xxhash64("treatment_id"), F.lit(files)))
            for k in range(files):
                _export(spark, rows.where(F.col("_file") == k), f"{path}/file={run}-{k}")
        got = extract_to_bronze(spark, path, bronze, f"r{run}", clock=_clock)
        read = read_files(spark, bronze, f"r{run}").select(F.regexp_extract("path", "^(.*)/", 1)).distinct().count()
        out.append((run, read, got["rows"]))
    return spark.createDataFrame(out, "run int, files int, n_rows long")


@query("rescued_attributes")
def q_rescued_attributes(spark, sf_dir):
    """Items with a field and with a group that no column has: kept as text and counted by name."""
    flat, bronze = flat_snapshot(spark, sf_dir), scratch_path(spark, "bronze")
    typed, status = F.col("treatment_type") == "1-URGENT", F.col("treatment_outcome_status") == "P"
    lines = sv.items_from_flat(flat).select(F.to_json("Item").alias("j"), F.col("Item.treatment.M")["type"]["S"].alias("treatment_type"),
                                            F.col("Item.treatment.M")["outcome_status"]["S"].alias("treatment_outcome_status"))
    noted = F.when(typed, F.regexp_replace("j", r'"treatment":\{"M":\{', '"treatment":{"M":{"note":{"S":"seen"},')).otherwise(F.col("j"))
    insured = F.when(status, F.concat(F.lit('{"insurance":{"M":{"plan":{"N":"7"}}},'), F.substring(noted, F.lit(2), F.length(noted)))).otherwise(noted)
    path = scratch_path(spark, "export")
    write_lines(lines.select(F.concat(F.lit('{"Item":'), insured, F.lit("}")).alias("value")), path)
    extract_to_bronze(spark, path, bronze, "r1", clock=_clock)
    return rescued(spark, bronze).groupBy("name").agg(F.sum("n").alias("n"))


@query("stream_arrivals")
def q_stream_arrivals(spark, sf_dir):
    """Exports land one after the other, the second with everything again: what the stream admits, drops and calls late."""
    flat, out = flat_snapshot(spark, sf_dir), []
    landing, bronze, ckpt = (scratch_path(spark, n) for n in ("landing", "bronze", "arrivals"))
    for i, rows in enumerate((flat.where(_upto_tie(flat) & (F.col("treatment_id") % 4 < 2)), flat)):
        _export(spark, rows, f"{landing}/e{i}")
        batches = stream_bronze(spark, f"{landing}/*", bronze, ckpt, delay=f"{DELAY_DAYS} days", timeout_s=900)
        out.append((i, *(sum(b[k] for b in batches) for k in ("lines_read", "admitted_items", "repeated_lines", "late_items"))))
    return spark.createDataFrame(out, "run int, lines_read long, admitted long, repeated long, late long")


@query("unwrap_deep")
def q_unwrap_deep(spark, sf_dir):
    """events.props in a map in a list in a map, every level tagged."""
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    line = F.concat(F.lit('{"d":{"M":{"items":{"L":[{"M":{"k":{"N":"'), F.coalesce("k", F.lit("")), F.lit('"},"type":{"S":'),
                    F.coalesce(F.substring(F.to_json(F.array("event_type")), F.lit(2), F.length(F.to_json(F.array("event_type"))) - 2), F.lit('""')),
                    F.lit('}}},{"NULL":true}]}}}}'))
    text = ev.select("event_id", F.from_json(line, GROUP).alias("parsed")).select("event_id", unwrap_group("parsed")["d"].alias("d"))
    return text.select("event_id", F.get_json_object("d", "$.items[0].k").alias("k"), F.get_json_object("d", "$.items[0].type").alias("event_type"),
                       (F.get_json_object("d", "$.items[1]") == "null").alias("nothing"))


@query("orc_layer")
def q_orc_layer(spark, sf_dir):
    """A layer in another format: written as ORC, read and counted through the same functions."""
    events, path = Tables(spark, sf_dir).events, scratch_path(spark, "orc")
    events.write.orc(path)
    rows = layers.read_layer(spark, path, events.schema, fmt="orc")
    return rows.withColumn("n_rows", F.lit(layers.count_rows(spark, path, fmt="orc")).cast("long"))


@query("tracker_clock")
def q_tracker_clock(spark, sf_dir):
    """A step's clock columns are UTC, whatever the session's zone."""
    path, zone = scratch_path(spark, "tracker"), spark.conf.get("spark.sql.session.timeZone")
    tracker = Tracker(spark, path, "clock")
    n = Tables(spark, sf_dir).orders.count()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        tracker.started("count", "source", "none", "orders", "none")
        tracker.finished("count", "source", "none", "orders", "none", n, n)
        now = spark.sql("SELECT CAST(to_utc_timestamp(current_timestamp(), current_timezone()) AS timestamp_ntz) AS t").first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    near = F.abs(F.timestamp_diff("SECOND", "created_at", F.lit(now).cast("timestamp_ntz"))) < 600
    return spark.read.schema(TRACKER_SCHEMA).parquet(path).select("step", "status", "destination_count", near.alias("utc"))


# --- merges by part (D0, D6-D9, C5), feed and marts (S3, E1-E7) ---------------------

ORDER_COLUMNS = ("o_orderkey", "o_orderdate", "o_totalprice")


def _orders_table(spark, sf_dir, **options) -> tuple[MergeTable, DataFrame]:
    orders = Tables(spark, sf_dir).orders.select(*ORDER_COLUMNS)
    table = MergeTable(spark, scratch_path(spark, "orders"), orders.schema, ["o_orderkey"], **options)
    table.merge(orders)
    return table, orders


@query("merge_hash_parts")
def q_merge_hash_parts(spark, sf_dir):
    """A batch of few keys into a table in hash parts."""
    table, orders = _orders_table(spark, sf_dir, buckets=16)
    table.merge(orders.where("o_orderkey % 500 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return table.read()


def _moved(orders: DataFrame) -> DataFrame:
    return orders.where("o_orderkey % 100 = 3").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS"))


@query("merge_moved_rows")
def q_merge_moved_rows(spark, sf_dir):
    """Parts by year: the batch's keys are looked up in the parts they were in, and move."""
    table, orders = _orders_table(spark, sf_dir, part=F.year("o_orderdate"))
    table.merge(_moved(orders))
    return table.read()


@query("merge_feed")
def q_merge_feed(spark, sf_dir):
    """What a merge changed: the rows that went and those that came."""
    table, orders = _orders_table(spark, sf_dir, part=F.year("o_orderdate"), feed=True)
    table.merge(_moved(orders).unionByName(orders.where("o_orderkey % 100 = 4")))  # the latter change nothing
    return table.changes(1)


@query("incremental_marts")
def q_incremental_marts(spark, sf_dir):
    """Marts kept by deltas over three batches: old versions of half the treatments, the other half, the true versions."""
    silver = silver_snapshot(spark, sf_dir)
    even = F.col("treatment_id") % 2 == 0
    older = silver.withColumns({WATERMARK_COLUMN: F.col(WATERMARK_COLUMN) - F.expr("INTERVAL 9 DAYS"), "treatment_cost": F.col("treatment_cost") + 1,
                                "provider_id": F.col("provider_id") % 3 + 1, COMBO_ID: F.lit(1),
                                "treatment_start_date": F.col("treatment_start_date") - F.expr("INTERVAL 40 DAYS")})
    gold, root = scratch_path(spark, "gold"), scratch_path(spark, "marts")
    for batch in (older.where(even), silver.where(~even), silver.where(even)):
        write_marts(spark, build_gold(spark, batch, gold, silver_is_stored=True), root)
    rank, cost = read_mart(spark, root, "provider_success_rate_rank"), read_mart(spark, root, "summary_avg_treatment_cost")
    months, places = read_mart(spark, root, "monthly_treatment_trends"), read_mart(spark, root, "geographical_treatment_distribution")
    nothing = F.lit(None).cast("double")
    text = F.col("provider_id").cast("string").alias("label")
    return (rank.select(F.lit("rank").alias("mart"), text, "total_treatments", "success_rate")
            .unionByName(cost.select(F.lit("cost").alias("mart"), text, F.lit(None).cast("long").alias("total_treatments"), F.col("avg_treatment_cost").alias("success_rate")))
            .unionByName(months.select(F.lit("months").alias("mart"), F.concat_ws(" ", F.col("year").cast("string"), "month").alias("label"), "total_treatments", "success_rate"))
            .unionByName(places.select(F.lit("places").alias("mart"), F.concat_ws(" ", "country", "state", "city").alias("label"), "total_treatments", nothing.alias("success_rate")))
            .withColumnRenamed("success_rate", "measure"))


# --- layouts (W1, W3) ---------------------------------------------------------------

BUCKETS = 8


def bucketed_star(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The fact and its providers as tables in the same buckets of the provider, and the combinations."""
    s = star_t(spark, sf_dir, True, PROVIDER_COLUMNS + PAIR_COLUMNS)
    names = [f"bucketed_{t}_{uuid.uuid4().hex[:8]}" for t in ("fact", "providers")]
    fact, providers = (write_bucketed(s[t], name, scratch_path(spark, name), ["provider_sk"], BUCKETS)
                       for t, name in zip(("fact_treatments", "dim_providers"), names))
    return fact, providers, s[COMBOS]


@query("bucketed_rank")
def q_bucketed_rank(spark, sf_dir):
    """E1 where fact and providers lie in the same buckets: grouped and joined without an exchange."""
    fact, providers, _ = bucketed_star(spark, sf_dir)
    return marts.provider_treatment_rank(fact, providers, ordered=False)


@query("write_layout_interleaved")
def q_write_layout_interleaved(spark, sf_dir):
    path = scratch_path(spark, "silver-interleaved")
    write_layout(silver_snapshot(spark, sf_dir), path, interleave=["treatment_start_date", "provider_id"])
    return layers.read_layer(spark, path, silver_schema())


@query("write_layout_interleaved_pruned")
def q_write_layout_interleaved_pruned(spark, sf_dir):
    """A filter on the second key alone, over files in interleaved order."""
    path = scratch_path(spark, "orders-interleaved")
    orders = Tables(spark, sf_dir).orders.select(*ORDER_COLUMNS, "o_custkey")
    write_layout(orders, path, interleave=["o_orderdate", "o_custkey"], num_partitions=8)
    return layers.read_layer(spark, path, orders.schema).where(F.col("o_custkey").between(100, 200))

