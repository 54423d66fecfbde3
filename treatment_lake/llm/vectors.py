"""Vectors as rows: which take part, as integers, and what is shared by searches over shards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 2.0 ** 52  # sums of products below this are exact in doubles


def as_doubles(vec: Column) -> Column:
    return F.transform(vec, lambda x: x.cast("double"))


def finite(vec: Column) -> Column:
    """The vector (of doubles) is there and holds neither a null nor a non-finite component."""
    inf = F.lit(float("inf"))
    return vec.isNotNull() & F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))


def floored(vec: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, as longs."""
    return F.transform(vec, lambda x: F.floor(x * scale))


def matrix(rows: Sequence, width: int | None = None) -> np.ndarray:
    """Rows of different lengths, filled up with 0."""
    width = max((len(r) for r in rows), default=0) if width is None else width
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def best_of_shards(found: DataFrame, keys: Sequence[str], k: int, shards: int) -> DataFrame:
    """Of rows ``keys, shard, score`` and others: the k best of each key by score, ties to the smaller ``vec_id``, as an
    array ``best``. At most k rows of a key come from a shard; they are merged in two steps, so no group holds more
    than k times the root of the number of shards."""
    rest = [c for c in found.columns if c not in (*keys, "shard", "score", "vec_id")]
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id", *rest)

    def merged(df: DataFrame, by: Sequence[str], what: Column) -> DataFrame:
        return df.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(what)), 1, k).alias("best"))

    salt = max(1, int(np.ceil(np.sqrt(shards))))
    some = merged(found.withColumn("salt", F.col("shard") % salt), [*keys, "salt"], entry)
    return merged(some.select(*keys, F.explode("best").alias("one")), keys, F.col("one"))
