"""Elias-Fano codes of non-decreasing integers, with select.

A value's lowest ``low_bits`` bits are stored as they are, its upper part in
unary: bit ``(value >> low_bits) + i`` of the upper bits is set for the i-th
value. That is about ``2 + log2(largest / count)`` bits a value. Where every
``EVERY``-th set bit stands is kept too (32 bits each), so ``select`` reads the
few words after a sample and no table of offsets.
"""

from __future__ import annotations

import struct

import numpy as np

EVERY = 256  # set bits between two samples
HEAD = "<QQIIQ"  # values, upper bits, low bits of a value, samples, largest value
HEAD_SIZE = struct.calcsize(HEAD)
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)  # set bits of a byte


def low_bits_for(count: int, largest: int) -> int:
    return max(0, (largest // count).bit_length() - 1) if count else 0


def encode(values: np.ndarray) -> bytes:
    """The code of non-decreasing non-negative integers (uint64)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n and (values[1:] < values[:-1]).any():
        raise ValueError("values must not decrease")
    largest = int(values[-1]) if n else 0
    low = low_bits_for(n, largest)
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    length = int(places[-1]) + 1 if n else 0
    upper = np.zeros(-(-length // 8) * 8, np.uint8)
    upper[places] = 1
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if low else np.empty((n, 0), np.uint8)
    samples = places[::EVERY].astype("<u4")
    return (struct.pack(HEAD, n, length, low, len(samples), largest) + samples.tobytes()
            + np.packbits(upper, bitorder="little").tobytes() + np.packbits(bits.ravel(), bitorder="little").tobytes())


class EliasFano:
    """Reads a code where it lies in ``raw``; ``size`` is its number of bytes."""

    def __init__(self, raw: bytes | memoryview, at: int = 0):
        self.count, self.length, self.low, n_samples, self.largest = struct.unpack_from(HEAD, raw, at)
        self.samples = np.frombuffer(raw, "<u4", n_samples, at + HEAD_SIZE)
        at_upper = at + HEAD_SIZE + 4 * n_samples
        self.upper = np.frombuffer(raw, np.uint8, -(-self.length // 8), at_upper)
        n_low = -(-self.count * self.low // 8)
        self.lower = np.frombuffer(raw, np.uint8, n_low, at_upper + len(self.upper))
        self.size = at_upper + len(self.upper) + n_low - at

    def _place(self, i: int) -> int:
        """Where the i-th set bit of the upper bits stands: from its sample, byte by byte."""
        start = int(self.samples[i // EVERY])
        left, byte = i % EVERY, start // 8
        if not left:
            return start
        first = int(self.upper[byte]) >> (start % 8)
        ones = int(ONES[first]) - 1  # without the sampled bit itself
        if left <= ones:
            return start + [b for b in range(8) if first >> b & 1][left]
        left -= ones
        while True:
            span = ONES[self.upper[byte + 1:byte + 1 + EVERY]]
            total = int(span.sum())
            if left <= total:
                upto = np.cumsum(span, dtype=np.int64)
                k = int(np.searchsorted(upto, left))
                left -= int(upto[k - 1]) if k else 0
                value = int(self.upper[byte + 1 + k])
                return 8 * (byte + 1 + k) + [b for b in range(8) if value >> b & 1][left - 1]
            left -= total
            byte += EVERY

    def select(self, i: int) -> int:
        """The i-th value (from 0)."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        return ((self._place(i) - i) << self.low) + int(self._lows(i, i + 1)[0])

    def _lows(self, a: int, z: int) -> np.ndarray:
        """The low parts of values a to z."""
        if not self.low:
            return np.zeros(z - a, np.uint64)
        first = a * self.low // 8
        bits = np.unpackbits(self.lower[first:-(-z * self.low // 8)], bitorder="little")
        bits = bits[a * self.low - 8 * first:][:(z - a) * self.low].reshape(z - a, self.low)
        return (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def run(self, a: int, z: int) -> np.ndarray:
        """The values from the a-th up to, not including, the z-th (uint64): one select, then the upper bits in a row."""
        if not 0 <= a <= z <= self.count:
            raise IndexError((a, z))
        if a == z:
            return np.empty(0, np.uint64)
        start, stop = self._place(a), self._place(z - 1)
        bits = np.unpackbits(self.upper[start // 8:stop // 8 + 1], bitorder="little")[start % 8:]
        places = start + np.flatnonzero(bits)[:z - a]
        return ((places - np.arange(a, z)).astype(np.uint64) << np.uint64(self.low)) + self._lows(a, z)
