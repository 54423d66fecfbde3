"""Whitening and hard-negative mining against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest


# ---- operator 12

def test_polynomial_and_roots_are_exact():
    from treatment_lake.llm import exact_spectrum as es

    rng = np.random.default_rng(1)
    for y in (rng.integers(-30, 30, (40, 7)), np.vstack([np.eye(5, dtype=int) * 3, np.zeros((3, 5), int)]), np.hstack([rng.integers(-5, 5, (30, 3))] * 2)):
        y = y.astype(object)
        m = len(y) * (y.T @ y) - np.outer(y.sum(axis=0), y.sum(axis=0))
        d, trace = len(m), int(np.trace(m))
        primes = es.primes_for(es.coefficient_bound(trace, d))
        poly = es.joined({p: es.polynomial_modulo(m, p) for p in primes})
        # Faddeev-LeVerrier, in exact integers
        want, power = [1], np.eye(d, dtype=object).astype(object) * 0
        for k in range(1, d + 1):
            power = m @ (power + want[-1] * np.eye(d, dtype=int).astype(object)) if k > 1 else m.copy()
            want.append(-int(np.trace(power)) // k)
        assert poly == want
        while poly[-1] == 0:
            poly = poly[:-1]
        single = es.without_repeats(poly)
        real = np.sort(np.linalg.eigvalsh(m.astype(float)))[::-1]
        for j in range(1, len(poly)):
            x, bits, _ = es.root(poly, single, j, trace)
            assert x / 2 ** bits == pytest.approx(real[j - 1], rel=1e-9)
            scaled = es.stretched(single, bits)
            assert es.value(scaled, x) == 0 or (es.value(scaled, x) > 0) != (es.value(scaled, x - 1) > 0)
    assert es.is_prime(2 ** 31 - 1) and not es.is_prime(46337 * 46339) and len(es.without_repeats([1, -6, 12, -8])) == 2


def whitened_by_numpy(rows, most, scale=64):
    ok = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(x) for _, x in ok)
    ok = [(i, tuple(x + [0] * (d - len(x)))) for i, x in ok]
    fit = np.array(sorted({x for _, x in ok}), float)
    n, mean = len(fit), fit.mean(axis=0)
    e, v = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    sums = [sum(int(x) for x in column) for column in fit.T]
    out = {}
    for i, x in ok:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out[i] = (n, deviation, (np.array(x) - mean) @ v / np.sqrt(e))
    return out, e / np.trace(np.cov(fit.T, bias=True))


def test_whitening_against_numpy(spark):
    from treatment_lake.llm.whitening import whiten

    rnd = random.Random(6)
    rows = [(i, [float(np.float32(rnd.gauss(0, 0.3 + 0.1 * k) + k)) for k in range(9)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(None, rows[3][1])]
    rows += [(2000, None), (2001, [0.1, None] + [0.0] * 7), (2002, [math.nan] * 9), (2003, [math.inf] * 9), (2004, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, component string").repartition(5)
    out = whiten(spark, df, 4).collect()
    want, explained = whitened_by_numpy(rows, 4)
    by_id = {}
    for r in out:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_id) == set(want) and len(out) == 4 * len(want)
    sign = {}
    for i, comps in by_id.items():
        n, deviation, w = want[i]
        for c in range(1, 5):
            r = comps[c]
            assert (r.n, r.deviation) == (n, deviation) and r.explained == pytest.approx(explained[c - 1], rel=1e-9) and r.identity_error < 1e-10
            if abs(w[c - 1]) > 1e-6:
                assert sign.setdefault(c, np.sign(r.whitened * w[c - 1])) == np.sign(r.whitened * w[c - 1])
                assert abs(r.whitened) == pytest.approx(abs(w[c - 1]), rel=1e-7)


def test_whitening_of_few_flat_and_far_vectors(spark):
    from treatment_lake.llm.whitening import whiten

    kind = "vec_id long, embedding array<double>"
    assert whiten(spark, spark.createDataFrame([], kind)).collect() == []
    assert whiten(spark, spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []  # no spread
    assert whiten(spark, spark.createDataFrame([(1, []), (2, None)], kind)).collect() == []
    line = whiten(spark, spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(6)], kind)).collect()
    assert {r.component for r in line} == {1} and {round(r.explained, 12) for r in line} == {1.0} and max(r.identity_error for r in line) < 1e-10
    square = whiten(spark, spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, -1.0])], kind)).collect()
    assert len(square) == 8 and {round(r.explained, 12) for r in square} == {0.5} and max(r.identity_error for r in square) < 1e-10
    far = whiten(spark, spark.createDataFrame([(i, [1e9 * i, (i * i % 5) * 1e8]) for i in range(9)], kind)).collect()
    assert len(far) == 18 and max(r.identity_error for r in far) < 1e-9 and all(r.deviation is None for r in far if r.vec_id in (0, 8))


def test_exact_sums_of_all_sizes():
    from treatment_lake.llm.whitening import gram

    rng = np.random.default_rng(2)
    for most in (100, 2 ** 19, 2 ** 30, 2 ** 39, 2 ** 55):
        y = rng.integers(-most, most, (300, 4))
        assert (gram(y) == y.astype(object).T @ y.astype(object)).all()


# ---- operator 13

def mined(rows, anchor, k=5, scale=256, percent=80):
    ok = sorted({(i, lab, tuple(math.floor(scale * x) for x in v)) for i, lab, v in rows
                 if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a, label, v in ok:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, other, w in ok if i != a)
        for s, p, _ in [x for x in scored if x[2]][:k]:
            window = [x for x in scored if not x[2] and percent * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(window)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_mining_against_brute_force(spark):
    from pyspark.sql import functions as F

    from treatment_lake.llm.threshold_mining import mine_negatives

    rnd = random.Random(8)
    rows = [(i, rnd.randrange(4), [float(np.float32(rnd.gauss(0.05, 0.2))) for _ in range(6)]) for i in range(260)]
    rows += [(i, i % 3, [0.5] * 6) for i in range(300, 345)]  # ties
    rows += [(400 + i, 1, [0.0] * 6) for i in range(12)] + [(420, 2, [0.0] * 6)]  # scores of 0
    rows += [(500, None, [0.1] * 6), (None, 1, [0.1] * 6), (510, 1, None), (520, 1, [math.nan] * 6), (530, 1, [0.1, None] + [0.0] * 4), (540, 3, [1.0, 1.0])]
    rows += [rows[20]] * 3
    df = spark.createDataFrame([(i, lab, v, 1, "x") for i, lab, v in rows], "vec_id long, label int, embedding array<float>, shard int, data string")
    want = mined(rows, lambda a: a % 20 == 0)
    assert len(want) > 100
    for shard_rows, block_rows in ((4096, 256), (30, 3), (1, 2)):
        assert found(mine_negatives(spark, df, F.col("vec_id") % 20 == 0, shard_rows=shard_rows, block_rows=block_rows)) == want
    assert found(mine_negatives(spark, df.limit(0), F.col("vec_id") % 20 == 0)) == []
    assert found(mine_negatives(spark, df, F.col("vec_id") == -1)) == []
    few = df.where("vec_id in (0, 20, 300, 301)")
    assert found(mine_negatives(spark, few, F.col("vec_id") % 20 == 0)) == mined([r for r in rows if r[0] in (0, 20, 300, 301)], lambda a: a % 20 == 0)


def test_mining_of_hot_ids_large_and_negative_scores(spark):
    from pyspark.sql import functions as F

    from treatment_lake.llm.threshold_mining import mine_negatives

    rnd = random.Random(9)
    rows = [(7, rnd.randrange(2), [rnd.uniform(-1, 1), rnd.uniform(-1, 1)]) for _ in range(60)]  # one id, many vectors
    rows += [(20, 0, [-1.0, -1.0]), (40, 0, [1.0, 1.0]), (60, 1, [1e6, 1e6]), (80, 1, [9e5, 9e5]), (81, 0, [8e5, 8.5e5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = found(mine_negatives(spark, df, F.col("vec_id") % 20 == 0, shard_rows=10, block_rows=2))
    assert out == mined(rows, lambda a: a % 20 == 0) and (60, 80, 1, 81) in {x[:4] for x in out}


def test_threshold_stops_before_the_end():
    from treatment_lake.llm.threshold_mining import SortedLists

    rng = np.random.default_rng(0)
    n = 4000
    points = rng.integers(-50, 51, (n, 2))
    held = SortedLists(np.arange(n), np.zeros(n, int), points, np.arange(n))
    everything = np.ones(n, bool)
    (best, scores), = held.best(np.array([3, -2]), everything, np.array([-np.inf]), np.array([np.inf]), 5)[0]
    exact = points @ np.array([3, -2])
    order = np.lexsort((np.arange(n), -exact))[:5]
    assert best.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert held.best(np.array([3, -2]), everything, np.array([-np.inf]), np.array([np.inf]), 5)[1] < n / 4
    assert held.best(np.array([0, 0]), everything, np.array([-np.inf]), np.array([np.inf]), 5)[0][0][0].tolist() == [0, 1, 2, 3, 4]
