"""Exact top-k search by inner product with a KD-tree per shard (operator 10).

Vectors become integers (``floor(scale * x)``), rows are dealt by a hash of
the whole row to shards of bounded size (one id may have many vectors), and each
shard is a KD-tree: median splits on the widest side, leaves with tight bounding
boxes, stored in the shared folder. Queries travel in blocks to the trees, a tree
never travels to blocks: both are dealt by shard, the tree first, so a task holds
one tree and one batch of blocks. The largest inner product that a box
can hold, ``sum(max(q * low, q * high))``, orders the leaves: a query visits
them best first and stops when the bound falls below its k-th score. A first
round over one shard per block gives its queries a k-th score (none, where that
shard has no rows), which the second round, over all shards, starts from.

Defined results
- vectors that are null or hold a null or non-finite component, and rows with
  a null id, take no part;
- ties go to the smaller id; rows equal in id and vector count once; rows that
  share the query's id are its own and not its candidates;
- vectors of different lengths: the missing components are 0;
- fewer than k candidates: all of them; empty table: empty result.
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

MOST_TASKS = 20_000
LAST = np.iinfo(np.int64).max


def clean(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, v`` (array of long) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), as_doubles(F.col(vec_col)).alias("x")).where(
        F.col("vec_id").isNotNull() & finite(F.col("x")))
    return rows.select("vec_id", floored(F.col("x"), scale).alias("v")).distinct()


def build_tree(ids: np.ndarray, points: np.ndarray, leaf_size: int) -> dict:
    """Points in leaf order, with each leaf's range, box and smallest id."""
    order, leaves, stack = np.arange(len(ids)), [], [(0, len(ids))]
    while stack:
        a, b = stack.pop()
        part = order[a:b]
        if b - a > leaf_size:
            spread = np.ptp(points[part], axis=0)
            middle = (b - a) // 2
            order[a:b] = part[np.argpartition(points[part, int(np.argmax(spread))], middle)] if spread.size else part
            stack += [(a, a + middle), (a + middle, b)]
        else:
            leaves.append((a, b))
    leaves.sort()
    ids, points = ids[order], points[order]
    return {"ids": ids, "points": points, "leaves": leaves,
            "low": np.array([points[a:b].min(axis=0) for a, b in leaves]).reshape(len(leaves), -1),
            "high": np.array([points[a:b].max(axis=0) for a, b in leaves]).reshape(len(leaves), -1),
            "least": np.array([ids[a:b].min() for a, b in leaves], dtype=np.int64)}


def search(block: dict, tree: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (queries x k, best first; id LAST where there is none) of one shard.

    Leaves are visited best bound first; ``block["kth"]`` is a score that each
    query's k-th best is known to reach."""
    width = max(block["points"].shape[1], tree["points"].shape[1])
    q, p, low, high = (widened(m, width) for m in (block["points"], tree["points"], tree["low"], tree["high"]))
    largest = float(np.abs(q).max(initial=0)) * float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))) * max(1, width)
    kind = np.float64 if largest < EXACT else object
    q, p, low, high = q.astype(kind), p.astype(kind), low.astype(kind), high.astype(kind)
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    n = len(q)
    lowest = -np.inf
    scores, ids = np.full((n, k), lowest, dtype=kind), np.full((n, k), LAST, dtype=np.int64)
    visit = np.argsort(-bound, axis=1, kind="stable")
    rows = np.arange(n)
    for step in range(bound.shape[1]):
        leaf = visit[:, step]
        reach = bound[rows, leaf]
        kth = np.maximum(scores[:, -1], block["kth"])
        if not (reach >= kth).any():
            break
        better = (reach > kth) | ((reach == kth) & ((scores[:, -1] < reach) | (tree["least"][leaf] < ids[:, -1])))
        for one in np.unique(leaf[better]):
            mine = np.flatnonzero(better & (leaf == one))
            a, b = tree["leaves"][one]
            found = q[mine] @ p[a:b].T
            own = block["ids"][mine][:, None] == tree["ids"][a:b][None, :]
            all_scores = np.concatenate([scores[mine], np.where(own, lowest, found)], axis=1)
            all_ids = np.concatenate([ids[mine], np.where(own, LAST, tree["ids"][a:b][None, :])], axis=1)
            best = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
            scores[mine], ids[mine] = np.take_along_axis(all_scores, best, 1), np.take_along_axis(all_ids, best, 1)
    return scores, ids


def _as_tree(shard_key: tuple, rows: pd.DataFrame, leaf_size: int) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    tree = build_tree(rows["vec_id"].to_numpy(np.int64), matrix(list(rows["v"])), leaf_size)
    return pd.DataFrame({"shard": [shard_key[0]], "tree": [pickle.dumps(tree)]})


def _as_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    block = {"ids": rows["vec_id"].to_numpy(np.int64), "numbers": rows["row_no"].to_numpy(np.int64), "points": matrix(list(rows["v"])),
             "kth": np.full(len(rows), -np.inf)}
    return pd.DataFrame({"block": [key[0]], "data": [pickle.dumps(block)]})


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, dict | None]]:
    """Rows ``shard, kind, block, data``, each tree (kind 0) before the blocks that ask it -> (shard, block, data, tree);
    no tree where the shard has no rows."""
    tree, at = None, None
    for batch in batches:
        for shard, kind, block, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if kind == 0:
                tree, at = pickle.loads(data), shard
            else:
                yield shard, block, data, tree if at == shard else None


def _first_round(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for _, number, data, tree in _met(batches):
        if tree is not None:
            block = pickle.loads(data)
            block["kth"] = search(block, tree, k)[0][:, -1]
            data = pickle.dumps(block)
        yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int32()), "data": pa.array([data], pa.binary())})


def _second_round(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for shard, _, data, tree in _met(batches):
        if tree is None:
            continue
        block = pickle.loads(data)
        scores, ids = search(block, tree, k)
        real = (ids != LAST) & (scores >= block["kth"][:, None])
        yield pa.RecordBatch.from_pydict({
            "query_no": pa.array(np.repeat(block["numbers"], k)[real.ravel()]), "shard": pa.array([shard] * int(real.sum()), pa.int32()),
            "vec_id": pa.array(ids[real]), "score": pa.array([int(x) for x in scores[real]], pa.int64())})


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = 256, shard_rows: int = 8192, block_rows: int = 1024,
          leaf_size: int = 128) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` (an expression over ``vec_id``) holds."""
    bounded_batches(spark)
    numbered = clean(vectors, id_col, vec_col, scale).withColumn("row_no", F.monotonically_increasing_id())
    rows = stored(spark, numbered, scratch_path(spark, "topk-rows"))
    queries = rows.where(is_query)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-sizes["q"] // block_rows))
    trees = stored(spark, rows.withColumn("shard", F.pmod(F.xxhash64("row_no"), F.lit(shards)).cast("int"))
                   .groupBy("shard").applyInPandas(lambda key, g: _as_tree(key, g, leaf_size), "shard int, tree binary"),
                   scratch_path(spark, "topk-trees"))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("row_no", F.lit(1)), F.lit(blocks)).cast("int"))
             .groupBy("block").applyInPandas(_as_block, "block int, data binary"))

    def with_trees(asking: DataFrame) -> DataFrame:
        both = trees.select("shard", F.lit(0).alias("kind"), F.lit(-1).alias("block"), F.col("tree").alias("data")).unionByName(
            asking.select("shard", F.lit(1).alias("kind"), "block", "data"))
        return both.repartition(max(1, min(shards, MOST_TASKS)), "shard").sortWithinPartitions("shard", "kind")

    seeded = stored(spark, with_trees(asked.withColumn("shard", F.pmod(F.col("block"), F.lit(shards)).cast("int")))
                    .mapInArrow(lambda it: _first_round(it, k), "block int, data binary"), scratch_path(spark, "topk-queries"))
    everywhere = seeded.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = with_trees(everywhere).mapInArrow(lambda it: _second_round(it, k), "query_no long, shard int, vec_id long, score long")
    best = best_of_shards(found, ["query_no"], k, shards)
    ids = queries.select(F.col("row_no").alias("query_no"), F.col("vec_id").alias("query_id"))
    return (best.join(ids, "query_no").select("query_id", F.posexplode("best").alias("p", "c"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "c.vec_id", (-F.col("c.minus")).alias("score")))


@query("op10_exact_topk", """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
