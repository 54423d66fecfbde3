"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .registry import stored

ONE_TASK = 500_000  # edges, 16 bytes each


def _one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest labels along the edges, with shortcuts, until nothing changes."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not held:
        return
    a, b = (np.concatenate(x) for x in zip(*held))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = index[:len(a)], index[len(a):], np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b):  # the ends and what they are labelled with
            np.minimum.at(new, end, least)
            np.minimum.at(new, label[end], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60, one_task: int = ONE_TASK) -> DataFrame:
    """``node, component`` (the smallest node that can be reached) for all nodes of ``edges`` (``a``, ``b`` long).

    Up to ``one_task`` different edges (a few MB) are settled in one task. Beyond
    that, by rounds of the alternating star contraction: every node links its larger
    neighbours to its smallest one, then its smaller ones; each round is two
    groupings and is written to the shared folder. The number of edges never
    grows, and a hot node only ever meets its minimum (an aggregate with a
    map side), joined back to the edges by key.
    """
    def ordered(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        joined = e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        return joined.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    now = stored(spark, ordered(edges), scratch_path(spark, "edges"))
    if now.count() <= one_task:
        found = now.repartition(1).mapInArrow(_one_task, "node long, component long")
        return stored(spark, found, scratch_path(spark, "components"))
    sign = None
    for _ in range(max_rounds):
        now = stored(spark, small_star(ordered(large_star(now))), scratch_path(spark, "edges"))
        r = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (r["n"], r["h"]) == sign or not r["n"]:
            break
        sign = (r["n"], r["h"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
