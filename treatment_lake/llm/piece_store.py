"""Ids of byte strings that recur, looked up with array operations and told apart by their bytes.

A string of at most 16 bytes is two 64-bit integers and a length; a hash of
the three only says where to look, and a hit counts when all three agree.
Longer strings, and strings whose hash meets another's, go through a plain
dictionary. So no choice of words makes one take another's ids.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

SHORT = 16  # bytes of a string that two integers hold
KEPT_LONG = 64  # longer strings are solved each time
MASKS = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2 ** 64 - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 whose results look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Level:
    """Sorted hashes of short strings with the strings themselves and where their ids are."""

    def __init__(self):
        self.columns = [np.empty(0, k) for k in (np.uint64, np.uint64, np.uint64, np.uint8, np.int64, np.int32)]

    def __len__(self) -> int:
        return len(self.columns[0])

    def add(self, columns: list[np.ndarray]) -> None:
        joined = [np.concatenate(x) for x in zip(self.columns, columns)]
        by = np.argsort(joined[0], kind="stable")
        self.columns = [x[by] for x in joined]

    def find(self, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each string: the same string is here, another of its hash is here, where its ids start, how many."""
        if not len(self):
            no = np.zeros(len(key), bool)
            return no, no, np.zeros(len(key), np.int64), np.zeros(len(key), np.int32)
        keys, los, his, sizes, at, count = self.columns
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        met = keys[place] == key
        same = met & (los[place] == lo) & (his[place] == hi) & (sizes[place] == size)
        return same, met & ~same, at[place], count[place]


class PieceStore:
    """``solve`` takes byte strings and returns their ids in a row (uint32) and the number of each. At most ``most``
    strings are remembered; when full, all are forgotten."""

    def __init__(self, solve: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int):
        self.solve, self.most = solve, most
        self.forget()

    def forget(self) -> None:
        self.levels, self.chunks, self.held = [Level(), Level()], [], 0
        self.long: dict[bytes, tuple[int, int]] = {}
        self.flat = np.empty(0, np.uint32)

    def _keep(self, ids: np.ndarray) -> int:
        """Puts ids at the end of the store; where they start."""
        at = self.held
        self.chunks.append(ids)
        self.held += len(ids)
        return at

    def _ids(self) -> np.ndarray:
        if self.chunks:
            self.flat = np.concatenate([self.flat, *self.chunks])
            self.chunks = []
        return self.flat

    def of(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of ``raw`` in a row (uint32), and how many ids come before each piece."""
        if sum(map(len, self.levels)) + len(self.long) > self.most:
            self.forget()
        size = ends - starts
        at, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        plain = np.flatnonzero(size <= SHORT)
        odd = [np.flatnonzero(size > SHORT)]
        if len(plain):
            odd.append(plain[self._short(raw, starts[plain], size[plain], plain, at, count)])
        odd = np.concatenate(odd)
        local = self._odd([raw[a:z] for a, z in zip(starts[odd].tolist(), ends[odd].tolist())], odd, at, count) if len(odd) else []
        before = np.r_[0, np.cumsum(count)]
        ids = np.concatenate([self._ids(), *local]) if local else self._ids()
        return ids[np.repeat(at - before[:-1], count) + np.arange(before[-1])], before

    def _short(self, raw: bytes, starts: np.ndarray, size: np.ndarray, where: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Fills in the short pieces; which of them have to go the plain way."""
        padded = raw + bytes(2 * SHORT)
        words = np.ndarray((len(raw) + SHORT,), "<u8", buffer=padded, strides=(1,))
        lo = words[starts] & MASKS[np.minimum(size, 8)]
        hi = words[starts + 8] & MASKS[np.clip(size - 8, 0, 8)]
        tag = size.astype(np.uint64)
        key = mix(mix(lo + tag * np.uint64(0x9E3779B97F4A7C15)) ^ (hi * np.uint64(0xD6E8FEB86659FD93)))
        keys, first, which = np.unique(key, return_index=True, return_inverse=True)
        odd = (lo != lo[first][which]) | (hi != hi[first][which]) | (size != size[first][which])
        mine = (keys, lo[first], hi[first], size[first].astype(np.uint8))
        found, clash, start, n = self.levels[0].find(*mine)
        found2, clash2, start2, n2 = self.levels[1].find(*mine)
        start, n = np.where(found, start, start2), np.where(found, n, n2)
        found |= found2
        clash = (clash | clash2) & ~found
        new = np.flatnonzero(~found & ~clash)
        if len(new):
            a = starts[first[new]]
            ids, per = self.solve([raw[x:y] for x, y in zip(a.tolist(), (a + size[first[new]]).tolist())])
            start[new] = self._keep(ids) + np.cumsum(per) - per
            n[new] = per
            self.levels[1].add([c[new] for c in mine] + [start[new], n[new].astype(np.int32)])
            if 8 * len(self.levels[1]) > len(self.levels[0]):
                self.levels[0].add(self.levels[1].columns)
                self.levels[1] = Level()
        odd |= clash[which]
        at[where], count[where] = start[which], n[which]
        return odd

    def _odd(self, words: list[bytes], where: np.ndarray, at: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
        """Fills in pieces by their whole bytes; ids that are not remembered come back."""
        once: dict[bytes, tuple[int, int]] = {}
        new = [w for w in dict.fromkeys(words) if w not in self.long]
        keep = [w for w in new if len(w) <= KEPT_LONG]
        other = [w for w in new if len(w) > KEPT_LONG]
        local = []
        for some, known in ((keep, self.long), (other, once)):
            if some:
                ids, n = self.solve(some)
                if known is once:
                    base = self.held
                    local.append(ids)
                else:
                    base = self._keep(ids)
                known.update(zip(some, zip((base + np.cumsum(n) - n).tolist(), n.tolist())))
        places = [self.long.get(w) or once[w] for w in words]
        at[where] = [p[0] for p in places]
        count[where] = [p[1] for p in places]
        return local
