"""Substring deduplication with two-stage suffix sorting (operator 6).

Every text is a string of UTF-8 bytes. Removes every byte that a window of
``width`` bytes covers whose bytes also start in a document with a smaller id.
``repeats`` finds the candidate windows; here they are cut into segments,
neighbouring windows that share a sampled k-gram, and equal samples meet in
one group (a group that is too large is split by longer grams, in the end by
the whole window). A group's segments are concatenated and sorted in two
stages:

1. only the suffixes smaller than their successors are sorted directly, to a
   depth of ``width`` bytes;
2. one scan over the buckets of first bytes, in order, induces all others: a
   suffix larger than its successor takes the next free place of its bucket
   when its successor is passed.

Neighbours in this order with a common prefix of ``width`` bytes or more hold
the same window; the smallest id of such a run is the answer for all of it.

Defined results
- null or empty text: no bytes, nothing removed; fewer than ``width`` bytes: nothing removed;
- null identifiers: compared with nobody, nothing removed;
- repeated rows (same id, same text): neither is smaller, both stay;
- very long texts: whole; empty table: empty result; extra columns are ignored;
- cuts may fall within a character: ``kept`` is binary.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .marks import gram_hashes, sliding_min
from .registry import query, table
from .repeats import Block, Bytes, Method, remove_repeats

BORDER = 0xFF  # ends a segment; no UTF-8 text has this byte


def word_columns(text: np.ndarray) -> np.ndarray:
    """For each place the next 8 bytes as one big-endian number (borders beyond the end)."""
    padded = np.concatenate([text, np.full(8, BORDER, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:i + len(text)].astype(np.uint64)
    return out


def depth_words(heads: np.ndarray, at: np.ndarray, depth: int):
    """The words of 8 bytes, the last one cut, that make up the first ``depth`` bytes of the suffixes ``at``."""
    n = len(heads)
    for offset in range(0, depth, 8):
        where = at + offset
        column = np.where(where < n, heads[np.minimum(where, n - 1)], np.uint64(0xFFFFFFFFFFFFFFFF))
        rest = depth - offset
        yield column if rest >= 8 else column >> np.uint64(8 * (8 - rest))


def sort_directly(heads: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ``at`` in the order of their first ``depth`` bytes; each word only orders what is still tied."""
    if not len(at):
        return at
    order, rank, tied = at, np.zeros(len(at), np.int64), np.arange(len(at))
    for column in depth_words(heads, at, depth):
        pass_ = column[tied]
        by = np.lexsort((pass_, rank[tied]))
        tied_sorted = tied[by]
        r, c = rank[tied_sorted], pass_[by]
        new = np.r_[True, (r[1:] != r[:-1]) | (c[1:] != c[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(new)])
        # a run's rank: the rank of its group plus the number of its members before it
        group_first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        group = np.cumsum(np.r_[True, r[1:] != r[:-1]]) - 1
        rank[tied_sorted] = np.repeat(r[first] + first - group_first[group[first]], size)
        tied = tied_sorted[np.repeat(size > 1, size)]
        if not len(tied):
            break
    return order[np.argsort(rank, kind="stable")]


def two_stage_sort(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``text`` (uint8, its last byte a BORDER) in the order of their first ``depth`` bytes, or of
    those up to the first border."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    wide = text.astype(np.int16)
    step = np.r_[np.sign(wide[1:] - wide[:-1]), -1]  # the end is smaller than all
    # equal neighbours: the next different byte decides
    following = np.where(step != 0, np.arange(n), n - 1)
    following = np.minimum.accumulate(following[::-1])[::-1]
    smaller = step[following] > 0  # than its successor
    heads = word_columns(text)
    direct = sort_directly(heads, np.flatnonzero(smaller), depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        mine = induced[c]
        wave = np.concatenate(mine) if mine else np.empty(0, np.int64)
        passed = []
        while len(wave):  # a run of c induces within its own bucket
            passed.append(wave)
            before = wave[wave > 0] - 1
            wave = before[text[before] == c]
        passed.append(direct[edges[c]:edges[c + 1]])
        bucket = np.concatenate(passed)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        before, first = before[first > c], first[first > c]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        for a, z in zip(*(lambda f: (f, np.r_[f[1:], len(first)]))(np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else np.empty(0, int))):
            induced[first[a]].append(before[a:z])
    return np.concatenate(out)


def same_as_before(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in order: has it a common prefix of ``depth`` bytes or more with the one before it?"""
    same = np.ones(len(order), bool)
    if len(order):
        same[0] = False
    for column in depth_words(word_columns(text), order, depth):
        same[1:] &= column[1:] == column[:-1]
    return same


class SuffixSort(Method):
    def __init__(self, width: int):
        self.width = width
        self.levels = sorted({max(1, width // 3), max(1, width // 2), max(1, width * 2 // 3), max(1, width * 5 // 6), width})

    def common(self, x: np.ndarray, level: int, kind: Bytes) -> np.ndarray:
        return sliding_min(gram_hashes(x, level, strong=False), self.width - level + 1)

    def items(self, block: Block, place: np.ndarray, run: np.ndarray, group: np.ndarray, common: np.ndarray, kind: Bytes):
        if not len(place):
            none = np.empty(0, np.int64)
            return [], none, none, none, none, none
        new = np.r_[True, (run[1:] != run[:-1]) | (group[1:] != group[:-1]) | (common[1:] != common[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(place)])
        begin, end = place[first].tolist(), (place[first] + size + self.width - 1).tolist()
        known: dict[tuple[bytes, int], int] = {}
        raw = block.tokens.raw
        which = np.fromiter((known.setdefault((raw[a:z], g), len(known)) for a, z, g in zip(begin, end, group[first].tolist())),
                            np.int64, len(first))
        ids = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(ids, which, block.ids[block.doc[run[first]]])
        of = np.fromiter((g for _, g in known), np.int64, len(known))
        per_item = np.fromiter((len(s) - self.width + 1 for s, _ in known), np.int64, len(known))
        segment = np.cumsum(new) - 1
        return [s for s, _ in known], per_item, ids, of, which[segment], np.arange(len(place)) - first[segment]

    def answers_of(self, item: bytes, kind: Bytes) -> int:
        return len(item) - self.width + 1

    def solve(self, items: list[bytes], ids: np.ndarray, kind: Bytes) -> np.ndarray:
        known: dict[bytes, int] = {}
        which = np.fromiter((known.setdefault(s, len(known)) for s in items), np.int64, len(items))
        least = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        text = np.frombuffer(b"".join(s + bytes([BORDER]) for s in known), np.uint8)
        length = np.fromiter(map(len, known), np.int64, len(known)) + 1
        begin = np.cumsum(length) - length
        owner = np.repeat(np.arange(len(known)), length)
        whole = np.arange(len(text)) + self.width <= (begin + length - 1)[owner]  # a window starts here
        order = two_stage_sort(text, self.width)
        order = order[whole[order]]
        start = np.flatnonzero(~same_as_before(text, order, self.width))
        smallest = np.minimum.reduceat(least[owner[order]], start)
        answer = np.empty(len(text), np.int64)
        answer[order] = np.repeat(smallest, np.diff(np.r_[start, len(order)]))
        return np.concatenate([answer[a:z] for a, z in zip(begin[which].tolist(), (begin + length - self.width)[which].tolist())])


def suffix_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50,
                 k: int = 24, carry: list[str] | None = None, **options) -> DataFrame:
    """See ``remove_repeats``; ``k``: bytes of the sampled grams."""
    return remove_repeats(spark, docs, Bytes(width, k), SuffixSort(width), id_col, text_col, carry, **options)


@query("op6_suffix_sort")
def op6_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
