"""Hard-negative mining with Fagin's threshold algorithm (operator 13).

Rows are dealt to shards of bounded size. A shard keeps, for each dimension,
its rows sorted by that component. An anchor reads the lists from the end
that its component's sign favours, one depth at a time; every row met is
scored exactly by random access (integer inner product). The inner product
of the anchor with the values last read is the threshold: no row that was not met
scores higher. An anchor is done with a shard as soon as the threshold is strictly
below the k-th score in each of its windows, or below the window's lower end.

Two searches of this kind: the positives of an anchor are the best rows of its
own label, under one open window; its negatives are the best rows of other labels in one
window for each positive. Anchors travel in blocks to the shards (a shard never
travels to blocks): rows of both are dealt by shard, the shard first, and a
task holds one shard and one batch of blocks.

Defined results
- rows with a null id or label, a null vector, or a null or non-finite component
  take no part; rows equal in id, label and vector count once, rows that only
  share an id count apart, and none of them is a candidate of the anchor whose id they share;
- ties go to the smaller id; vectors of different lengths: the missing
  components are 0; components must fit 64 bits after scaling, and so must scores;
- a positive with a score below 0 has an empty window; one of score 0 the window 0;
- fewer than k candidates: all of them; no anchors or empty table: empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .registry import bounded_batches, query, stored, table
from .vectors import EXACT, as_doubles, best_of_shards, finite, floored, matrix, widened

FIRST_DEPTH = 8  # list places read before the first look at the threshold; doubled each time
MOST_TASKS = 20_000


def labelled_rows(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, label, v, row_no`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          as_doubles(F.col(vec_col)).alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("x")))
    return (rows.select("vec_id", "label", floored(F.col("x"), scale).alias("v")).distinct()
            .withColumn("row_no", F.monotonically_increasing_id()))


class SortedLists:
    """A shard: its rows, and for each dimension their order by that component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, row_no: np.ndarray):
        by = np.lexsort((row_no, ids))
        self.ids, self.labels, self.points, self.row_no = ids[by], labels[by], points[by], row_no[by]
        self.order = np.argsort(self.points, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(self.points.T, self.order, axis=1)
        self.largest = float(np.abs(self.points.astype(float)).max(initial=0))

    def best(self, point: np.ndarray, eligible: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[list[np.ndarray], int]:
        """For each window ``[low, high]`` the places of its k best eligible rows (best score first, ties to the smaller
        id) with their scores, and how deep the lists were read."""
        n, d = self.points.shape
        kind = np.float64 if float(np.abs(point.astype(float)).max(initial=0)) * self.largest * max(1, d) < EXACT else object
        point, points = point.astype(kind), self.points.astype(kind, copy=False)
        up, down = np.flatnonzero(point > 0), np.flatnonzero(point < 0)
        met, scores, depth, step = np.zeros(n, bool), np.full(n, -np.inf, kind), 0, FIRST_DEPTH
        open_windows = low <= high
        while depth < n and open_windows.any():
            upto = min(n, depth + step) if len(up) + len(down) else n
            fresh = np.zeros(n, bool)
            fresh[self.order[up, n - upto:n - depth]] = True
            fresh[self.order[down, depth:upto]] = True
            if upto == n:
                fresh[:] = True
            fresh &= ~met
            met |= fresh
            at = np.flatnonzero(fresh & eligible)
            scores[at] = points[at] @ point
            threshold = (point[up] * self.values[up, n - upto]).sum() + (point[down] * self.values[down, upto - 1]).sum()
            depth, step = upto, 2 * step
            for w in np.flatnonzero(open_windows):
                inside = scores[(scores >= low[w]) & (scores <= high[w])]
                kth = np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else -np.inf
                open_windows[w] = not threshold < max(kth, low[w])
            if met.all():
                break
        out = []
        for lo, hi in zip(low, high):
            at = np.flatnonzero((scores >= lo) & (scores <= hi) & (scores > -np.inf))
            best = at[np.lexsort((self.ids[at], -scores[at]))][:k]
            out.append((best, scores[best]))
        return out, depth


def _shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    held = {"ids": rows["vec_id"].to_numpy(np.int64), "labels": rows["label"].to_numpy(np.int64),
            "points": matrix(list(rows["v"])), "row_no": rows["row_no"].to_numpy(np.int64)}
    return pd.DataFrame({"shard": [key[0]], "data": [pickle.dumps(held)]})


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    held = {"ids": rows["vec_id"].to_numpy(np.int64), "labels": rows["label"].to_numpy(np.int64), "points": matrix(list(rows["v"])),
            "row_no": rows["row_no"].to_numpy(np.int64),
            "windows": [[(int(w["row_no"]), int(w["low"]), int(w["high"])) for w in ws] for ws in rows["windows"]]}
    return pd.DataFrame({"data": [pickle.dumps(held)]})


OPEN = -1  # the positive of a window that takes every score

FOUND = "anchor_no long, window_no long, shard int, vec_id long, row_no long, score long"


def _search(batches: Iterator[pa.RecordBatch], k: int, same_label: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``shard, kind, data`` in order: each shard (kind 0), then the blocks that ask it."""
    held, at = None, None
    for batch in batches:
        for shard, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if kind == 0:
                held, at = SortedLists(**pickle.loads(data)), shard
                continue
            if at != shard:  # a shard without rows
                continue
            out = answers(held, pickle.loads(data), k, same_label)
            n = len(out[0])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array([shard] * n, pa.int32()),
                                              *(pa.array(x, pa.int64()) for x in out[2:])],
                                             names=["anchor_no", "window_no", "shard", "vec_id", "row_no", "score"])


def answers(held: SortedLists, block: dict, k: int, same_label: bool) -> list[list[int]]:
    """anchor_no, window_no, vec_id, row_no, score of the best rows of one shard for each anchor of a block."""
    out: list[list[int]] = [[], [], [], [], []]
    width = max(block["points"].shape[1], held.points.shape[1])
    if width > held.points.shape[1]:
        held = SortedLists(held.ids, held.labels, widened(held.points, width), held.row_no)
    points = widened(block["points"], width)
    for i, windows in enumerate(block["windows"]):
        if not windows:
            continue
        eligible = (held.labels == block["labels"][i]) == same_label
        eligible &= held.ids != block["ids"][i]
        low = np.array([-np.inf if w[0] == OPEN else w[1] for w in windows], object if max(abs(w[1]) for w in windows) > EXACT else float)
        high = np.array([np.inf if w[0] == OPEN else w[2] for w in windows], low.dtype)
        for (number, _, _), (at, scores) in zip(windows, held.best(points[i], eligible, low, high, k)[0]):
            n = len(at)
            for column, values in zip(out, ([int(block["row_no"][i])] * n, [number] * n, held.ids[at].tolist(),
                                            held.row_no[at].tolist(), [int(s) for s in scores])):
                column.extend(values)
    return out


def searched(spark: SparkSession, anchors: DataFrame, lists: DataFrame, shards: int, block_rows: int, n_anchors: int, k: int,
             same_label: bool) -> DataFrame:
    """``FOUND`` rows of every shard for every anchor (``vec_id, label, v, row_no, windows``)."""
    blocks = max(1, -(-n_anchors // block_rows))
    asking = (anchors.withColumn("block", F.pmod(F.xxhash64("row_no"), F.lit(blocks))).groupBy("block")
              .applyInPandas(_block, "data binary"))
    asking = asking.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "data")
    both = lists.select("shard", F.lit(0).alias("kind"), "data").unionByName(asking)
    dealt = both.repartition(max(1, min(shards, MOST_TASKS)), "shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(lambda it: _search(it, k, same_label), FOUND)


def mine_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   least_percent: int = 80, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   scale: int = 256, shard_rows: int = 4096, block_rows: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor (``is_anchor`` is an
    expression over ``vec_id``) and each of its best rows of the same label, the best rows of other labels whose score
    is at least ``least_percent`` of the positive's and not above it."""
    bounded_batches(spark)
    rows = stored(spark, labelled_rows(vectors, id_col, label_col, vec_col, scale), scratch_path(spark, "mining-rows"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("a")).first()
    shards = max(1, -(-sizes["n"] // shard_rows))
    lists = stored(spark, rows.withColumn("shard", F.pmod(F.xxhash64("row_no"), F.lit(shards)).cast("int"))
                   .groupBy("shard").applyInPandas(_shard, "shard int, data binary"), scratch_path(spark, "mining-lists"))
    anchors = rows.where(is_anchor)
    everything = F.array(F.struct(F.lit(OPEN).cast("long").alias("row_no"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")))
    found = searched(spark, anchors.withColumn("windows", everything), lists, shards, block_rows, sizes["a"], positives, True)
    best = best_of_shards(found.drop("window_no"), ["anchor_no"], positives, shards)
    own = stored(spark, best.select("anchor_no", F.explode("best").alias("p"))
                 .select("anchor_no", F.col("p.row_no").alias("window_no"), F.col("p.vec_id").alias("positive_id"),
                         (-F.col("p.minus")).alias("positive_score")), scratch_path(spark, "mining-positives"))
    score = F.col("positive_score")
    # the least whole number that is not below least_percent of the score
    least = F.expr(f"cast(((cast(positive_score as decimal(38,0)) * {least_percent} + 99) div 100) as long)")
    windows = own.where(score >= 0).groupBy("anchor_no").agg(
        F.collect_list(F.struct(F.col("window_no").alias("row_no"), least.alias("low"), score.alias("high"))).alias("windows"))
    asked = anchors.join(windows, anchors["row_no"] == windows["anchor_no"]).drop("anchor_no")
    found = searched(spark, asked, lists, shards, block_rows, sizes["a"], negatives, False)
    best = best_of_shards(found.drop("row_no"), ["anchor_no", "window_no"], negatives, shards)
    ids = anchors.select(F.col("row_no").alias("anchor_no"), F.col("vec_id").alias("anchor_id"))
    return (best.join(own, ["anchor_no", "window_no"]).join(ids, "anchor_no")
            .select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("place", "b"))
            .select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("negative_id"),
                    "positive_score", (-F.col("b.minus")).alias("negative_score")))


@query("op13_negative_mining", """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
     s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
           FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER w <= 5
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id)""")
def op13_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return mine_negatives(spark, vectors, F.col("vec_id") % 100 == 0)
