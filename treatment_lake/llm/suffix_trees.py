"""Substring deduplication with prefix-partitioned suffix trees (operator 8).

Removes every word that a window of ``width`` words covers whose words also
start in a document with a smaller id. ``repeats`` finds the candidate
windows; here their suffixes (from a window's first word on) are split by
variable-length prefixes: by the first word, and where a prefix's group is too
large, by one more word, until groups fit in memory. Each group becomes a
suffix tree, built from the sorted suffixes and their common prefixes;
internal nodes at least ``width`` words deep are repeats, and their smallest
id is the answer for all suffixes below.

Defined results
- null or empty text: no words, nothing removed; fewer than ``width`` words: nothing removed;
- null identifiers: compared with nobody, nothing removed;
- repeated rows (same id, same text): neither is smaller, both stay;
- very long texts: whole; empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .marks import gram_hashes
from .registry import query, table
from .repeats import Block, Method, Words, remove_repeats


def common_words(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def suffix_tree(suffixes: list[bytes], ids: list[int], width: int, least_depth: int = 1) -> list[tuple[int, int, int, int]]:
    """Internal nodes (depth in words, first and end suffix, smallest id) of the tree of sorted suffixes of at most
    ``width`` words that are at least ``least_depth`` words deep; of the shallower ones nothing is built."""
    nodes, stack = [], []  # open nodes: [depth, first, smallest id]

    def close(depth: int, end: int) -> int | None:
        first = None
        while stack and stack[-1][0] > depth:
            d, first, least = stack.pop()
            nodes.append((d, first, end, least))
            if stack:
                stack[-1][2] = min(stack[-1][2], least)
        return first

    for i in range(1, len(suffixes)):
        if suffixes[i] == suffixes[i - 1]:
            depth = width
        elif least_depth < width:
            depth = common_words(suffixes[i - 1].split(b" "), suffixes[i].split(b" "))
        else:
            depth = 0
        first = close(depth, i)
        if depth >= least_depth:
            if not stack or stack[-1][0] < depth:
                stack.append([depth, i - 1 if first is None else first, ids[i - 1] if first is None else nodes[-1][3]])
            stack[-1][2] = min(stack[-1][2], ids[i])
    close(0, len(suffixes))
    return nodes


class PrefixTrees(Method):
    def __init__(self, width: int):
        self.levels = list(range(1, width + 1))

    def common(self, x: np.ndarray, level: int, kind: Words) -> np.ndarray:
        return gram_hashes(x, level, strong=False)

    def items(self, block: Block, place: np.ndarray, run: np.ndarray, group: np.ndarray, common: np.ndarray, kind: Words):
        known: dict[bytes, int] = {}
        windows = block.tokens.pieces(place, place + kind.width) if len(place) else []
        item = np.fromiter((known.setdefault(w, len(known)) for w in windows), np.int64, len(place))
        ids = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(ids, item, block.ids[block.doc[run]])
        of = np.empty(len(known), np.int64)
        of[item] = group
        return list(known), np.ones(len(known), np.int64), ids, of, item, np.zeros(len(place), np.int64)

    def solve(self, items: list[bytes], ids: np.ndarray, kind: Words) -> np.ndarray:
        order = sorted(range(len(items)), key=items.__getitem__)
        answers = ids.copy()
        order_ids = np.array(order, np.int64)
        for _, first, end, least in suffix_tree([items[i] for i in order], ids[order_ids].tolist(), kind.width, kind.width):
            answers[order_ids[first:end]] = least
        return answers


def substring_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                    k: int = 5, carry: list[str] | None = None, **options) -> DataFrame:
    """See ``remove_repeats``; ``k``: words of the sampled grams."""
    return remove_repeats(spark, docs, Words(width, k), PrefixTrees(width), id_col, text_col, carry, **options)


@query("op8_substring_trees")
def op8_substring_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
