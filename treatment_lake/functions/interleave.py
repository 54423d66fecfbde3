"""Interleaved sort keys: the bits of several columns' value ranks in turn.

A value's rank is the number of the column's quantile bounds that are not above it
(2 ** bits - 1 bounds from one approximate aggregate, so the ranks are spread
evenly whatever the distribution). The bounds become a balanced tree of
comparisons, and the bits are interleaved with shifts: all native expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_BITS = 8


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list]:
    """Distinct bounds of each column, ascending (at most ``2 ** bits - 1`` values to the driver); numbers, dates and times."""
    n = 2 ** bits
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    row = df.agg(*[F.percentile_approx(c, shares, F.lit(40 * n)).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def value_rank(c: Column, bounds: Sequence) -> Column:
    """How many of the ascending bounds are not above the value; 0 for NULL."""
    def tree(a: int, z: int) -> Column:  # the rank is known to lie from a to z
        if a == z:
            return F.lit(a)
        mid = (a + z) // 2
        return F.when(c >= F.lit(bounds[mid]), tree(mid + 1, z)).otherwise(tree(a, mid))
    return tree(0, len(bounds))


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """One long whose bits are those of the ranks in turn, the first column's first."""
    k = len(ranks)
    if k * bits > 63:
        raise ValueError(f"{k} columns of {bits} bits do not fit a long")
    out = F.lit(0).cast("long")
    for i, rank in enumerate(ranks):
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * k + (k - 1 - i)))
    return out


def interleaved_key(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column:
    bounds = quantile_bounds(df, columns, bits)
    return interleaved([value_rank(F.col(c), bounds[c]) for c in columns], bits)
