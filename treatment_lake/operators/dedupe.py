"""Latest row per key.

``max(struct(order..., rest...))`` grouped by the key is a hash/sort
aggregate with a map-side partial step: however many versions a hot key
has, each map task forwards one row per key, so a key that holds a third
of the data does not land whole in one task (a ``row_number`` window would
sort every version of that key in a single partition).

Order: the ``order_by`` columns descending, then every remaining column
descending, so the pick is total and repeatable. NULL sorts lowest, i.e.
a non-NULL value wins over NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
                   drop_null_keys: bool = True) -> DataFrame:
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = order_by + rest
    if drop_null_keys:
        df = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    if not ranked:
        return df.select(*keys).distinct()
    best = F.max(F.struct(*[F.col(c) for c in ranked])).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*[F.col(k) for k in keys], *[F.col("_best")[c].alias(c) for c in ranked])
            .select(*df.columns))
