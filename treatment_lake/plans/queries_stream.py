"""Named queries: streaming ingestion and the streaming gold build."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.sinks import write_table
from ..schemas import silver_schema
from ..session import scratch_path
from ..sources.tables import Tables
from ..streaming.ingest import ingest_files, stream_gold
from .gold import gold_tables, read_mart
from .registry import query, silver_snapshot

STREAM_TIMEOUT_S = 900


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Events land in three files; three availableNow runs (the last with nothing
    new) must deliver every event exactly once."""
    events = Tables(spark, sf_dir).events
    landing = scratch_path(spark, "landing")
    sink = scratch_path(spark, "sink")
    ckpt = scratch_path(spark, "ckpt")
    et = F.col("event_type")
    batches = [("batch_001", et == "click"), ("batch_002", et == "view"),
               ("batch_003", ~et.isin("click", "view") | et.isNull())]
    write_table(events.where(batches[0][1]), f"{landing}/{batches[0][0]}")
    ingest_files(spark, f"{landing}/*", events.schema, sink, ckpt, timeout_s=STREAM_TIMEOUT_S)
    for name, cond in batches[1:]:
        write_table(events.where(cond), f"{landing}/{name}")
    ingest_files(spark, f"{landing}/*", events.schema, sink, ckpt, timeout_s=STREAM_TIMEOUT_S)
    ingest_files(spark, f"{landing}/*", events.schema, sink, ckpt, timeout_s=STREAM_TIMEOUT_S)
    return spark.read.schema(events.schema).parquet(sink)


def _stream_gold(spark, sf_dir, order) -> tuple[str, str]:
    """Silver lands in three files by outcome status, in the given order, one run per file; (gold, marts)."""
    silver = silver_snapshot(spark, sf_dir)
    landing = scratch_path(spark, "silver-landing")
    gold, marts, ckpt = (scratch_path(spark, n) for n in ("gold", "marts", "ckpt"))
    st = F.col("treatment_outcome_status")
    conditions = {"F": st == "F", "O": st == "O", "other": ~st.isin("F", "O") | st.isNull()}
    for i, name in enumerate(order):
        write_table(silver.where(conditions[name]), f"{landing}/batch_{i:03d}")
        stream_gold(spark, f"{landing}/*", silver_schema(), gold, marts, ckpt, timeout_s=STREAM_TIMEOUT_S,
                    refresh_marts=i == len(order) - 1)
    return gold, marts


@query("stream_star")
def q_stream_star(spark, sf_dir):
    """Each run merges the new rows into gold, the last one rebuilds the marts. The final E1 equals the batch E1."""
    return read_mart(spark, _stream_gold(spark, sf_dir, ("F", "O", "other"))[1], "provider_treatment_rank")


@query("stream_star_providers")
def q_stream_star_providers(spark, sf_dir):
    """The provider dimension after batches in another order equals the batch build."""
    return gold_tables(spark, _stream_gold(spark, sf_dir, ("other", "O", "F"))[0])["dim_providers"].read()


@query("stream_star_fact")
def q_stream_star_fact(spark, sf_dir):
    """The fact likewise."""
    return gold_tables(spark, _stream_gold(spark, sf_dir, ("O", "F", "other"))[0])["fact_treatments"].read()
