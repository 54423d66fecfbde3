"""Eigenvalues and eigenvectors of a symmetric positive semidefinite integer matrix from its characteristic polynomial.

Nothing here depends on the number of rows a matrix was made from: the sizes
are the dimension and the bits of its entries. The residues modulo many primes
and the roots are independent of each other, so callers spread them over tasks.
"""

from __future__ import annotations

import decimal
from collections.abc import Sequence
from math import comb

import numpy as np

TOP = 2 ** 31  # primes are below this: products of residues fit 64 bits
GUARD_BITS = 96  # a root is known to so many bits beyond its isolation
RELATIVE_BITS = 90  # and to so many bits of its own
ITERATIONS = 3


def is_prime(n: int) -> bool:
    """Exact for odd n below 3.2e9 (bases 2, 3, 5, 7)."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        if n % a == 0:
            return n == a
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(r - 1)):
            return False
    return True


def coefficient_bound(trace: int, d: int) -> int:
    """No coefficient of the polynomial is larger: the k-th is a sum of C(d, k) products of k eigenvalues, none of them
    negative, and by Maclaurin's inequality at most C(d, k) * (trace / d) ** k."""
    return max(-(-comb(d, k) * trace ** k // d ** k) for k in range(d + 1))


def primes_for(bound: int) -> list[int]:
    """Primes below TOP whose product tells apart all integers from -bound to bound."""
    out, product, n = [], 1, TOP - 1
    while product <= 2 * bound + 1:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo p, highest first: reduction to Hessenberg form, then its recurrence."""
    h = np.array(matrix % p, dtype=np.int64)
    d = len(h)
    for k in range(1, d - 1):
        rows = np.flatnonzero(h[k:, k - 1])
        if not len(rows):
            continue
        i = k + int(rows[0])
        if i != k:
            h[[k, i]] = h[[i, k]]
            h[:, [k, i]] = h[:, [i, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factor % p).sum(axis=1)) % p
    polys = [np.array([1], np.int64)]  # lowest first
    for k in range(d):
        last = polys[-1]
        new = np.zeros(k + 2, np.int64)
        new[1:] = last
        new[:-1] = (new[:-1] - int(h[k, k]) * last) % p
        below = 1
        for i in range(1, k + 1):
            below = below * int(h[k - i + 1, k - i]) % p
            if not below:
                break
            c = int(h[k - i, k]) * below % p
            older = polys[k - i]
            new[:len(older)] = (new[:len(older)] - c * older) % p
        polys.append(new)
    return [int(c) % p for c in polys[-1][::-1]]


def joined(residues: dict[int, Sequence[int]]) -> list[int]:
    """The integers (of either sign) with these residues, by Chinese remaindering."""
    product = 1
    for p in residues:
        product *= p
    out = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        rest = product // p
        weight = rest * pow(rest, -1, p)
        for i, v in enumerate(values):
            out[i] += weight * v
    out = [x % product for x in out]
    return [x - product if 2 * x > product else x for x in out]


# ---- polynomials with integer coefficients, highest first, all of whose roots are real

def value(poly: Sequence[int], x: int) -> int:
    out = 0
    for c in poly:
        out = out * x + c
    return out


def stretched(poly: Sequence[int], bits: int) -> list[int]:
    """The polynomial whose roots are ``2 ** bits`` times as large."""
    return [c << (bits * i) for i, c in enumerate(poly)]


def roots_above(poly: Sequence[int], a: int) -> int:
    """How many roots (with multiplicity) are above a: moved by a, the number of sign changes of the coefficients is that
    of the positive roots, exactly, as all roots are real."""
    c = list(poly)
    d = len(c) - 1
    for i in range(d):
        for j in range(1, d + 1 - i):
            c[j] += a * c[j - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _content_free(poly: list[int]) -> list[int]:
    from math import gcd

    while poly and not poly[0]:
        poly = poly[1:]
    g = gcd(*poly) if poly else 1
    return [c // g for c in poly] if g > 1 else poly


def _remainder(a: list[int], b: list[int]) -> list[int]:
    """A multiple of the remainder of a by b."""
    a = list(a)
    while len(a) >= len(b):
        lead = a[0]
        a = [b[0] * x for x in a]
        for i, c in enumerate(b):
            a[i] -= lead * c
        a = _content_free(a[1:])
        if not a:
            break
    return a


def _degree_of_gcd_modulo(a: list[int], b: list[int], p: int) -> int:
    a, b = [x % p for x in a], [x % p for x in b]
    while b and any(b):
        while b and not b[0]:
            b = b[1:]
        inverse = pow(b[0], -1, p)
        while len(a) >= len(b):
            f = a[0] * inverse % p
            a = [(x - f * y) % p for x, y in zip(a, b)] + a[len(b):]
            a = a[1:]
        a, b = b, a
    return len(a) - 1


def without_repeats(poly: list[int]) -> list[int]:
    """The polynomial with the same roots, each once."""
    d = len(poly) - 1
    slope = [c * (d - i) for i, c in enumerate(poly[:-1])]
    if d < 2 or any(poly[0] % p and slope[0] % p and _degree_of_gcd_modulo(poly, slope, p) == 0 for p in (TOP - 1, TOP - 19, TOP - 61)):
        return list(poly)
    a, b = _content_free(poly), _content_free(slope)
    while b:
        a, b = b, _content_free(_remainder(a, b))
    rest, out = [c * a[0] ** (len(poly) - len(a) + 1) for c in poly], []
    while len(rest) >= len(a):
        q = rest[0] // a[0]
        out.append(q)
        rest = [x - q * y for x, y in zip(rest, a)] + rest[len(a):]
        rest = rest[1:]
    return _content_free(out)


def root(poly: list[int], single: list[int], j: int, most: int) -> tuple[int, int, int]:
    """The j-th largest root (from 1, with multiplicity; above 0, at most ``most``): ``(x, bits, nth)``, the root being
    at most ``x / 2 ** bits`` and less than ``2 ** -bits`` below it; it is the nth of equal roots. ``single`` has each root of ``poly`` once."""
    lo, hi, bits = -1, most, 0
    while True:
        wide = stretched(poly, bits)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if roots_above(wide, mid) >= j else (lo, mid)
        once = stretched(single, bits)
        if roots_above(once, lo) - roots_above(once, hi) == 1:
            break
        lo, hi, bits = lo << 16, hi << 16, bits + 16
    nth = j - roots_above(wide, hi)
    goal = bits + GUARD_BITS
    while bits < goal or hi.bit_length() < RELATIVE_BITS:
        lo, hi, bits = lo << 32, hi << 32, bits + 32
        once = stretched(single, bits)
        sign = value(once, hi)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            v = value(once, mid)
            if sign == 0:  # the root is hi itself
                lo = hi - 1
            elif v == 0:
                lo, hi, sign = mid - 1, mid, 0
            elif (v > 0) == (sign > 0):
                hi = mid
            else:
                lo = mid
    return hi, bits, nth


def null_vectors(matrix: Sequence[Sequence[int]], x: int, bits: int, count: int, known: Sequence = ()) -> list[list[float]]:
    """``count`` orthonormal vectors of the (near) null space of ``matrix - x / 2 ** bits``, by inverse iteration from
    fixed start vectors with one elimination. Each has its largest entry above 0."""
    d = len(matrix)
    largest = max((abs(v) for row in matrix for v in row), default=1)
    with decimal.localcontext() as ctx:
        ctx.prec = 60 + len(str(largest)) + bits * 31 // 100
        ctx.Emax, ctx.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        shift = decimal.Decimal(x) / decimal.Decimal(2 ** bits)
        a = np.array([[decimal.Decimal(int(v)) for v in row] for row in matrix], dtype=object)
        a[np.arange(d), np.arange(d)] -= shift
        order = []
        tiny = decimal.Decimal(largest + 1).scaleb(-ctx.prec + 5)
        for k in range(d):
            i = k + int(np.argmax(np.abs(a[k:, k])))
            a[[k, i]] = a[[i, k]]
            order.append(i)
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1:, k] /= a[k, k]
            a[k + 1:, k + 1:] -= a[k + 1:, k, None] * a[None, k, k + 1:]

        def solve(v: np.ndarray) -> np.ndarray:
            v = v.copy()
            for k, i in enumerate(order):
                v[[k, i]] = v[[i, k]]
                v[k + 1:] -= a[k + 1:, k] * v[k]
            for k in range(d - 1, -1, -1):
                v[k] = v[k] / a[k, k]
                v[:k] -= a[:k, k] * v[k]
            return v

        out: list[np.ndarray] = []
        for c in range(count):
            rng = np.random.default_rng(c + 1)
            v = np.array([decimal.Decimal(int(s)) for s in rng.integers(1, 1000, d) * rng.choice([-1, 1], d)], dtype=object)
            for _ in range(ITERATIONS):
                v = solve(v)
                for _ in range(2):
                    for u in out:
                        v = v - u * (u * v).sum()
                    v = v / (v * v).sum().sqrt()
            out.append(v if v[int(np.argmax(np.abs(v)))] > 0 else -v)
        return [[float(t) for t in v] for v in out]
