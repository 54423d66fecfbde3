"""Data quality checks: keys, NULLs, lengths, orphans.

Each check is one aggregate pass (partial aggregation on the map side), so
a hot key or a wide table costs one scan; results are small frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stack(df: DataFrame, names: Sequence[str], value_cols: Sequence[str], label: str = "column_name"):
    """One row per name from a one-row frame holding ``<value>_<name>`` columns."""
    parts = []
    for n in names:
        parts.append(f"'{n}', " + ", ".join(f"`{v}_{n}`" for v in value_cols))
    expr = f"stack({len(names)}, {', '.join(parts)}) AS ({label}, {', '.join(value_cols)})"
    return df.selectExpr(expr)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null) for every column, in one pass."""
    cols = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in cols])
    return _stack(one, cols, ["n_null"])


def check_lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(column_name, max_length, length_limit, n_over) for declared VARCHAR limits."""
    cols = [c for c in limits if c in df.columns]
    aggs = []
    for c in cols:
        ln = F.length(F.col(c))
        aggs += [F.max(ln).cast("int").alias(f"max_length_{c}"),
                 F.lit(int(limits[c])).alias(f"length_limit_{c}"),
                 F.count_if(ln > F.lit(int(limits[c]))).alias(f"n_over_{c}")]
    one = df.agg(*aggs)
    return _stack(one, cols, ["max_length", "length_limit", "n_over"])


def check_orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """(key, n): child key values with no parent row; NULL keys are not orphans.

    Child rows are first reduced to one row per key (partial aggregation),
    so the anti join sees each key once however skewed the child is.
    """
    per_key = child.where(F.col(child_col).isNotNull()).groupBy(child_col) \
        .agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_col).alias("_pk")).where(F.col("_pk").isNotNull())
    return per_key.join(parents, per_key[child_col] == parents["_pk"], "left_anti") \
        .select(F.col(child_col).alias("orphan_key"), "n")


def _labelled_keys(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(foreign_key, key) rows: ``df`` unpivoted over the given (label, column)
    pairs in one projection (``stack``), NULL keys dropped."""
    parts = ", ".join(f"'{label}', CAST(`{col}` AS BIGINT)" for label, col in pairs)
    return (df.selectExpr(f"stack({len(pairs)}, {parts}) AS (foreign_key, key)")
            .where(F.col("key").isNotNull()))


def check_all_orphans(children: Mapping[str, DataFrame], parents: Mapping[str, DataFrame],
                      foreign_keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Orphans for every declared foreign key, labelled ``child.column``.
    Child tables come from ``children``, parent tables from ``parents``
    (pass the same mapping twice to check one star against itself).

    Each child table is scanned once: all of its foreign-key columns are
    unpivoted into (foreign_key, key) rows and counted per pair with a single
    grouped aggregate (partial on the map side, so a hot key is one row per
    task). Parent keys are unpivoted the same way, each parent column once,
    and one anti join on (foreign_key, key) finds the orphans.
    """
    fks = [fk for fk in foreign_keys if fk[0] in children and fk[2] in parents]
    if not fks:
        return None
    by_child: dict[str, list[tuple[str, str]]] = {}
    for child, ccol, _, _ in fks:
        by_child.setdefault(child, []).append((f"{child}.{ccol}", ccol))
    per_key = None
    for child, pairs in by_child.items():
        k = _labelled_keys(children[child], pairs)
        per_key = k if per_key is None else per_key.unionByName(k)
    per_key = per_key.groupBy("foreign_key", "key").agg(F.count(F.lit(1)).alias("n"))

    # One branch per parent table: its key column labelled with every
    # foreign key that references it.
    by_parent: dict[tuple[str, str], list[str]] = {}
    for child, ccol, parent, pcol in fks:
        by_parent.setdefault((parent, pcol), []).append(f"{child}.{ccol}")
    known = None
    for (parent, pcol), labels in by_parent.items():
        k = _labelled_keys(parents[parent], [(label, pcol) for label in labels])
        known = k if known is None else known.unionByName(k)
    return (per_key.join(known, ["foreign_key", "key"], "left_anti")
            .select("foreign_key", F.col("key").alias("orphan_key"), "n"))
