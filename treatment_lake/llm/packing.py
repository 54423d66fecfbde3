"""Packing by non-negative least squares (operator 1).

Documents become token ids, are cut into pieces of at most one window, and
the pieces are packed by a plan that is made on the histogram of their
lengths alone:

1. pass over the texts: ids, pieces, checksums; each piece gets its running
   number within (task, length class) - a written table, no text in it;
2. the histogram (at most ``window / grid`` classes) goes to the driver,
   which enumerates the combinations of up to ``depth`` classes that fill the
   window, solves repeat counts by non-negative least squares, rounds them
   down, and packs what is left greedily, again by classes;
3. a piece's rank within its class (running number plus the counts of the
   tasks before) picks its slot in the plan: sequence id and place.

The driver's work and the broadcast plan depend on the number of classes
only, never on the number of documents; no group of equal lengths (a third
of all rows may be copies) is ever gathered: ranks come from per-task counts.

Defined results
- null or empty text: the end id alone, a piece of length 1;
- null identifiers and repeated rows: packed like any other row;
- very long text: as many full windows as fit, each a sequence of its own,
  then the rest as one piece;
- empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

import array
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .piece_store import PieceStore
from .registry import bounded_batches, query, stored, table
from .worker import memo

CACHE_ENTRIES = 1_000_000  # distinct words whose ids a worker remembers; cleared when full, never wrong
SLICE = 2_000_000  # characters tokenised at once
BETWEEN = "<|startoftext|>"  # a special token of the vocabulary
WORD_END = "</w>"  # ends the last token of every word, in this vocabulary

#: Latin texts without apostrophes: letters that normalisation leaves alone but for their case, ASCII digits and
#: punctuation. Their words are the runs of letters, the runs of punctuation and the single digits.
PLAIN = re.compile("[\t\n\r -&(-~\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")
KIND = np.full(256, 2, np.uint8)  # of a byte of such a text: 0 blank, 1 letter, 2 punctuation, 3 digit
KIND[[9, 10, 13, 32]] = 0
KIND[[*range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 3


class LatinIds:
    """Ids of plain Latin texts, many texts at a time: words are found and told apart (by their bytes) with array
    operations, and only words not seen before go to the tokenizer."""

    def __init__(self, tokenizer):
        vocabulary = tokenizer.get_vocab()
        self.tokenizer, self.ends = tokenizer, np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith(WORD_END)
        self.store = PieceStore(self.learn, CACHE_ENTRIES)

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts, counts = [], []
        for a in range(0, len(words), 10_000):
            text = b" ".join(words[a:a + 10_000]).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            parts.append(ids)
            counts.append(np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))
        n = np.concatenate(counts)
        if len(n) != len(words):
            raise ValueError("the vocabulary does not end each word with one token")
        return np.concatenate(parts), n

    def of(self, texts: list[str]) -> list[bytes]:
        low = [t.lower().encode() for t in texts]
        raw = b" ".join(low) + b" "
        kind = KIND[np.frombuffer(raw, np.uint8)]
        single, word = kind == 3, kind != 0
        starts = np.flatnonzero(word & (single | np.r_[True, kind[1:] != kind[:-1]]))
        ends = np.flatnonzero(word & (single | np.r_[kind[1:] != kind[:-1], True])) + 1
        found, before = self.store.of(raw, starts, ends)
        ids = found.astype("<u4").tobytes()
        text_starts = np.cumsum([0, *(len(t) + 1 for t in low)])
        cuts = (4 * before[np.searchsorted(starts, text_starts)]).tolist()
        return [ids[a:z] for a, z in zip(cuts, cuts[1:])]


class WordIds(dict):
    """Ids of white-space-free chunks as little-endian uint32 bytes.

    The tokenizer's rules never look across a space or a line feed, so a
    text's ids are those of its chunks in a row; chunks not seen before go to
    the tokenizer together."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(BETWEEN)
        self.latin = LatinIds(self.tokenizer) if self.tokenizer.get_vocab_size() and "a" + WORD_END in self.tokenizer.get_vocab() else None
        self[""] = b""

    def learn(self, chunks: list[str]) -> None:
        """Many chunks in one call, a special token between them; chunks that may hold one themselves go alone."""
        plain = [c for c in chunks if "<|" not in c] if self.between is not None else []
        for c in chunks:
            if "<|" in c or self.between is None:
                self[c] = _le(self.tokenizer.encode(c, add_special_tokens=False).ids)
        for at in range(0, len(plain), 10_000):
            part = plain[at:at + 10_000]
            ids = np.array(self.tokenizer.encode_batch_fast([BETWEEN.join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self.between).tolist()
            raw = ids.tobytes()
            self.update((c, raw[4 * a:4 * z]) for c, a, z in zip(part, [0, *(x + 1 for x in cuts)], [*cuts, len(ids)]))

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        plain = [self.latin is not None and "<|" not in t and PLAIN.fullmatch(t) is not None for t in texts]
        done = iter(self.latin.of([t for t, p in zip(texts, plain) if p]) if any(plain) else ())
        rest = iter(self.by_chunks([t for t, p in zip(texts, plain) if not p]))
        return [next(done if p else rest) for p in plain]

    def by_chunks(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*split).difference(self)
        if new:
            if len(self) + len(new) > CACHE_ENTRIES:
                self.clear()
                self[""] = b""
                new = set().union(*split).difference(self)
            self.learn(list(new))
        return [b"".join(map(self.__getitem__, chunks)) for chunks in split]


def slices(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about SLICE characters; a longer text is alone."""
    out, size = [], 0
    for text in texts:
        text = text or ""
        if out and size + len(text) > SLICE:
            yield out
            out, size = [], 0
        out.append(text)
        size += len(text)
    if out:
        yield out


def _le(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes() if ids else b""


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, window: int, grid: int, end_id: int):
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    words, seen = memo(("words", path), lambda: WordIds(path)), Counter()
    part = TaskContext.get().partitionId()
    end = _le([end_id])
    for batch in batches:
        owner, start, length, crc, total, unit, nth = ([] for _ in range(7))
        encoded = (ids for part in slices(batch.column(1).to_pylist()) for ids in words.of(part))
        for row, ids in enumerate(encoded):
            ids += end
            n = len(ids) // 4
            for a in range(0, n, window):
                b = min(n, a + window)
                u = -(-(b - a) // grid)
                owner.append(row), start.append(a), length.append(b - a), total.append(n), unit.append(u)
                crc.append(zlib.crc32(ids[4 * a:4 * b]))
                nth.append(seen[u])
                seen[u] += 1
        cols = [batch.column(0).take(pa.array(owner, pa.int64()))]
        cols += [pa.array(array.array("q", x)) for x in (start, length, crc, total)]
        cols += [pa.array(unit, pa.int32()), pa.array(array.array("q", nth)), pa.array([part] * len(owner), pa.int32())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "unit", "nth", "part"])


def pieces_of(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, window: int, grid: int,
              end_id: int, vocab: str | None, path: str) -> DataFrame:
    """All pieces as a written table (no texts)."""
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _pieces(it, vocab, window, grid, end_id),
                          f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, unit int, nth long, part int")
    return stored(spark, out, path)


# ---- the plan: classes only

def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """Non-decreasing combinations of 1 to ``depth`` classes that sum to ``units``."""
    def grow(left: int, least: int, slots: int) -> Iterator[tuple[int, ...]]:
        yield (left,)
        if slots > 1:
            for a in range(least, left // 2 + 1):
                for rest in grow(left - a, a, slots - 1):
                    yield (a, *rest)
    return sorted(set(grow(units, 1, depth)))


def solve_nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Active-set solution of min ||a x - b||, x >= 0."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds or 3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        passive[best] = True
        while True:
            idx = np.flatnonzero(passive)
            z = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if z.size == 0 or z.min() > 0:
                x[:] = 0
                x[idx] = z
                break
            bad = z <= 0
            old = x[idx]
            step = np.min(old[bad] / np.maximum(old[bad] - z[bad], 1e-300))
            x[idx] = old + step * (z - old)
            drop = idx[(x[idx] <= 1e-12) & bad]
            x[drop] = 0
            passive[drop] = False
            if not drop.size:
                break
    return x


def make_plan(counts: dict[int, int], units: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(classes of one sequence, how many such sequences) that use every piece once."""
    left = Counter({u: n for u, n in counts.items() if n})
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(classes: tuple[int, ...], times: int) -> None:
        if times > 0:
            plan.append((classes, times))
            for u, m in Counter(classes).items():
                left[u] -= m * times
                if not left[u]:
                    del left[u]

    take((units,), left[units])
    if left:
        shapes = [c for c in combinations(units, depth) if len(c) > 1 and all(u in left for u in c)]
        if shapes:
            a = np.zeros((units + 1, len(shapes)))
            for k, c in enumerate(shapes):
                for u in c:
                    a[u, k] += 1
            b = np.zeros(units + 1)
            for u, n in left.items():
                b[u] = n
            used = np.flatnonzero(b)
            for k, times in enumerate(np.floor(solve_nnls(a[used], b[used]) + 1e-9).astype(int)):
                need = Counter(shapes[k])
                take(shapes[k], min([int(times), *(left[u] // m for u, m in need.items())]))
    while left:  # residuals: the longest class, then always the longest that still fits
        room, have, classes = units, Counter(left), []
        while True:
            u = max((u for u in have if u <= room and have[u] > 0), default=None)
            if u is None:
                break
            m = min(have[u], room // u)
            classes += [u] * m
            have[u] -= m
            room -= m * u
        take(tuple(classes), min(left[u] // m for u, m in Counter(classes).items()))
    return plan


def slots_of(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, pieces of the class in a sequence, first sequence id)."""
    at, base, out = Counter(), 0, []
    for classes, times in plan:
        for u, m in sorted(Counter(classes).items()):
            out.append((u, at[u], at[u] + m * times, m, base))
            at[u] += m * times
        base += times
    return out


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         grid: int = 8, depth: int = 3, end_id: int = 1, vocab: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``grid``: lengths are planned in classes of so many tokens (a sequence
    wastes less than that for each of its pieces); ``vocab``: the tokenizer's
    file on the executors (default: the installed public one).
    """
    if window % grid:
        raise ValueError("window must be a multiple of grid")
    pieces = pieces_of(spark, docs, id_col, text_col, window, grid, end_id, vocab, scratch_path(spark, "pieces"))
    per_task = pieces.groupBy("part", "unit").agg(F.count(F.lit(1)).alias("n"))
    totals = {r.unit: r.n for r in per_task.groupBy("unit").agg(F.sum("n").alias("n")).collect()}  # <= window / grid rows
    slots = slots_of(make_plan(totals, window // grid, depth))
    plan = spark.createDataFrame(slots, "s_unit int, lo long, hi long, m long, base long")
    before = Window.partitionBy("unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("part", "unit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "unit"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = (ranked.join(F.broadcast(plan), (F.col("unit") == F.col("s_unit")) & (F.col("rank") >= F.col("lo"))
                          & (F.col("rank") < F.col("hi")))
              .withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("m"))))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("unit"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))


@query("op1_pack_nnls")
def op1_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
