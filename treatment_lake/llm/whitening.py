"""Embedding whitening by the exact characteristic polynomial (operator 12).

Vectors become integers, the fit list is each distinct one once, and its
scatter ``n * sum(x x') - S S'`` (``n**2`` times the covariance) is summed in
exact integers. Its characteristic polynomial comes from many primes: a task
reduces the matrix modulo a prime to Hessenberg form, and the residues are joined
by Chinese remaindering, enough primes being taken to exceed a proven bound of
the coefficients. All its roots are real, so counts of sign changes isolate each
exactly; a root is then refined to about 100 bits, and inverse iteration in
decimals of that precision gives its component. One task finds one component.

What the driver holds depends on the dimension alone: sums, polynomial and
components. Rows are read for the distinct list, and once more for the output;
the list is read for the sums and for the check of the result.

Defined results
- null vector, null or non-finite component: the row is dropped; a null id stays;
- repeated rows: each is returned; equal vectors count once in the fit;
- equal eigenvalues: orthonormal components, numbered in a fixed order;
- eigenvalue 0: no component, as whitening would divide by 0: there are at most
  as many components as the rank, none for one distinct vector or an empty table;
- vectors of different lengths: the missing entries are 0;
- a deviation that exceeds 64 bits is null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import exact_spectrum as spectrum
from .registry import bounded_batches, query, stored, table
from .vectors import as_doubles, finite, floored

LIMB = 20  # bits of an integer that go into one product of doubles
ROWS = 4096  # rows multiplied at once: 2 ** (2 * LIMB + 12) is below 2 ** 53


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, y`` (``floor(scale * c)`` as longs) of the rows that remain."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), as_doubles(F.col(vec_col)).alias("c"))
    return rows.where(finite(F.col("c"))).select("vec_id", floored(F.col("c"), scale).alias("y"))


def filled(rows: DataFrame, width: int) -> DataFrame:
    """Shorter vectors end in zeros."""
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("y"))
    return rows.withColumn("y", F.when(F.size("y") < width, F.concat("y", zeros)).otherwise(F.col("y")))


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` in exact integers (of an int64 matrix of at most ROWS rows)."""
    largest = int(np.abs(y).max(initial=0))
    if 0 <= largest < 1 << LIMB:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    if 0 <= largest < 1 << 2 * LIMB:
        high = (y >> LIMB)
        f, g = high.astype(float), (y - (high << LIMB)).astype(float)
        cross = (f.T @ g).astype(np.int64).astype(object)
        return ((f.T @ f).astype(np.int64).astype(object) << 2 * LIMB) + ((cross + cross.T) << LIMB) + (g.T @ g).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _exact_sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A task's number of rows (-1, -1), sums (-1, j) and products (i, j), i <= j."""
    n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
    for batch in batches:
        y = as_matrix(batch.column(0), width)
        for a in range(0, len(y), ROWS):
            part = y[a:a + ROWS]
            n += len(part)
            sums += part.astype(object).sum(axis=0) if np.abs(part).max(initial=0) > 1 << 50 else part.sum(axis=0).astype(object)
            products += gram(part)
    i, j = np.triu_indices(width)
    values = [n, *sums, *products[i, j]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, np.full(width, -1), i], pa.int32()), pa.array(np.r_[-1, np.arange(width), j], pa.int32()),
         pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["i", "j", "v"])


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Number, sums and products of the list's vectors as integers (width squared numbers to the driver)."""
    parts = fit.select("y").mapInArrow(lambda it: _exact_sums(it, width), "i int, j int, v decimal(38,0)")
    n, sums, products = 0, [0] * width, np.zeros((width, width), object)
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        v = int(r["v"])
        if r["j"] < 0:
            n = v
        elif r["i"] < 0:
            sums[r["j"]] = v
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = v
    return n, sums, products


def polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """The characteristic polynomial of a positive semidefinite integer matrix, its primes spread over tasks."""
    d = len(scatter)
    primes = spectrum.primes_for(spectrum.coefficient_bound(int(np.trace(scatter)), d))

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"p": frame["p"], "c": [spectrum.polynomial_modulo(scatter, int(p)) for p in frame["p"]]})

    tasks = max(1, min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    found = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInPandas(residues, "p long, c array<long>")
    return spectrum.joined({r["p"]: r["c"] for r in found.collect()})


def components(spark: SparkSession, scatter: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """(eigenvalue, unit eigenvector) of the largest eigenvalues above 0, at most ``most``; one task for each."""
    trace = int(np.trace(scatter))
    poly = polynomial(spark, scatter)
    while len(poly) > 1 and poly[-1] == 0:  # eigenvalue 0
        poly = poly[:-1]
    rank = len(poly) - 1
    if not rank:
        return []
    single, rows = spectrum.without_repeats(poly), scatter.tolist()

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for j in frame["component"]:
                x, bits, nth = spectrum.root(poly, single, int(j), trace)
                out.append((int(j), float(Decimal(x) / Decimal(2 ** bits)), spectrum.null_vectors(rows, x, bits, nth)[-1]))
            yield pd.DataFrame(out, columns=["component", "root", "vector"])

    wanted = min(most, rank)
    found = spark.createDataFrame([(j,) for j in range(1, wanted + 1)], "component int").repartition(wanted, "component")
    rows_found = found.mapInPandas(solve, "component int, root double, vector array<double>").collect()
    return [(r["root"], np.array(r["vector"])) for r in sorted(rows_found, key=lambda r: r["component"])]


def projector(n: int, sums: list[int], found: list[tuple[float, np.ndarray]]) -> Callable[[np.ndarray], tuple[np.ndarray, list]]:
    """For int64 rows y: the whitened rows, and the exact sum of ``(n * y - S) ** 2`` of each."""
    weights = np.array([v * (n / math.sqrt(e)) for e, v in found]).T  # the covariance's eigenvalue is e / n ** 2
    low, high = min(sums), max(sums)

    def project(y: np.ndarray) -> tuple[np.ndarray, list]:
        reach = n * int(np.abs(y).max(initial=0)) + max(abs(low), abs(high))
        small = reach * reach * max(1, y.shape[1]) < 2 ** 63
        centred = y * np.int64(n) - np.array(sums, np.int64) if small else y.astype(object) * n - np.array(sums, object)
        squares = (centred * centred).sum(axis=1).tolist()
        return (centred.astype(float) / n) @ weights, [s if s < 2 ** 63 else None for s in squares]
    return project


def _covariance_sums(batches: Iterator[pa.RecordBatch], width: int, project) -> Iterator[pd.DataFrame]:
    total, products = 0.0, 0.0
    for batch in batches:
        w, _ = project(as_matrix(batch.column(0), width))
        total, products = total + w.sum(axis=0), products + w.T @ w
    if not np.isscalar(products):
        k = len(products)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.full(k, -1), i], pa.int32()), pa.array(np.r_[np.arange(k), j], pa.int32()),
                                          pa.array(np.r_[total, products[i, j]])], names=["i", "j", "v"])


def identity_error(fit: DataFrame, width: int, n: int, count: int, project) -> float:
    """The largest absolute entry of the whitened list's covariance minus the identity, measured on the whitened rows."""
    parts = fit.select("y").mapInArrow(lambda it: _covariance_sums(it, width, project), "i int, j int, v double")
    mean, cov = np.zeros(count), np.zeros((count, count))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["i"] < 0:
            mean[r["j"]] = r["v"] / n
        else:
            cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["v"] / n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(count)).max())


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(batches: Iterator[pa.RecordBatch], width: int, n: int, explained: np.ndarray, error: float, project) -> Iterator[pa.RecordBatch]:
    k = len(explained)
    for batch in batches:
        w, deviation = project(as_matrix(batch.column(1), width))
        rows = len(w)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
             pa.array(np.full(rows * k, n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
             pa.array(w.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
            names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(spark: SparkSession, vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: int = 64) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row that remains and each of
    the first ``most`` components. Adding a constant to all entries changes no result, so none is added."""
    bounded_batches(spark)
    rows = integer_rows(vectors, id_col, vec_col, scale)
    width = rows.agg(F.max(F.size("y"))).first()[0] or 0
    empty = spark.createDataFrame([], OUTPUT)
    if not width:
        return empty
    rows = filled(rows, width)
    fit = stored(spark, rows.select("y").distinct(), scratch_path(spark, "whitening-fit"))
    n, sums, products = moments(fit, width)
    scatter = n * products - np.outer(np.array(sums, object), np.array(sums, object))
    found = components(spark, scatter, most)
    if not found:
        return empty
    project = projector(n, sums, found)
    error = identity_error(fit, width, n, len(found), project)
    explained = np.array([e for e, _ in found]) / float(np.trace(scatter))
    return rows.select("vec_id", "y").mapInArrow(lambda it: _whitened(it, width, n, explained, error, project), OUTPUT)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, table(spark, sf_dir, "embeddings"))
