"""Repeated windows across documents: what both substring operators share.

A window is ``width`` neighbouring tokens (bytes or words) of one document.
``find_repeats`` finds the windows that also start in a document with a
smaller id, in five steps:

1. every text's sampled k-gram hashes are compared (``marks``); sampling is by
   the minimum over a window, so equal windows sample the same k-gram. Equal
   texts fold into the smallest id here, the others are copies as a whole;
2. the stretches whose windows have a shared sample go, document by document,
   into blocks of bounded size, a table in the shared folder;
3. each block's distinct window hashes meet by hash range; what occurs in one
   document only drops out;
4. what is left goes to the exact method (a suffix sort or suffix trees over
   the windows themselves) in groups that are split until they are small;
5. the smallest id of every window goes back to its block, and windows with a
   smaller one than their document's become spans.

A window that a third of all documents share is one item per block in steps
3 and 4, and answers travel per block, so no group grows with its copies.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .marks import Extract, gram_hashes, merged_marks, mix, piece_hashes, planes, shared_marks, slices, sliding_min, unplaned
from .registry import stored
from .worker import memo

GROUP_WINDOWS = 600_000  # windows (with one per block counted) that one group of the exact method takes


def squeeze(x: bytes) -> bytes:
    return memo(("zstd out",), lambda: zstandard.ZstdCompressor(level=1)).compress(x)


def unsqueeze(x: bytes) -> bytes:
    return memo(("zstd in",), zstandard.ZstdDecompressor).decompress(x)


class Tokens:
    """The tokens of a text whose bytes are ``raw``; ``starts`` and ``ends`` are the words' places (none: every byte is one)."""

    def __init__(self, raw: bytes, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.raw, self.starts, self.ends = raw, starts, ends

    def __len__(self) -> int:
        return len(self.raw) if self.starts is None else len(self.starts)

    def pieces(self, first: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The bytes of the tokens [first, end) of each pair (never empty)."""
        if self.starts is not None:
            first, end = self.starts[first], self.ends[end - 1]
        raw = self.raw
        return [raw[a:z] for a, z in zip(first.tolist(), end.tolist())]


class Bytes:
    """Tokens are the bytes of a text."""

    between = b""
    block_bytes = 750_000  # text of one block: a worker holds a dozen arrays of as many 8-byte numbers

    def __init__(self, width: int, k: int):
        self.width, self.k = width, k

    def plain(self, raw: bytes) -> bytes:
        return raw

    def count(self, plain: bytes) -> int:
        return len(plain)

    def tokens(self, plain: bytes) -> Tokens:
        return Tokens(plain)

    def numbers(self, tokens: Tokens) -> np.ndarray:
        return np.frombuffer(tokens.raw, np.uint8).astype(np.uint64) + np.uint64(1)


class Words:
    """Tokens are the words of a text, what stands between ASCII white space; plain: one space between words."""

    between = b" "
    block_bytes = 4_000_000
    def __init__(self, width: int, k: int):
        self.width, self.k = width, k

    def plain(self, raw: bytes) -> bytes:
        return b" ".join(raw.split())

    def count(self, plain: bytes) -> int:
        return plain.count(b" ") + 1 if plain else 0

    def tokens(self, plain: bytes) -> Tokens:
        if not plain:
            return Tokens(plain, np.empty(0, np.int64), np.empty(0, np.int64))
        spaces = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
        return Tokens(plain, np.r_[0, spaces + 1], np.r_[spaces, len(plain)])

    def numbers(self, tokens: Tokens) -> np.ndarray:
        return piece_hashes(tokens.raw, tokens.starts, tokens.ends)


def samples(kind, x: np.ndarray) -> np.ndarray:
    """Each window's sample: the least of its k-gram hashes."""
    if len(x) < kind.width:
        return np.empty(0, np.uint64)
    return sliding_min(gram_hashes(x, kind.k, strong=False), kind.width - kind.k + 1)


def text_key(plain: bytes) -> bytes:
    return xxhash.xxh3_128_digest(plain)


def sampled(kind, plains: list[bytes]) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray]:
    """Of several texts put in a row: all tokens, all windows' samples, each text's first token and number of windows."""
    n = np.fromiter(map(kind.count, plains), np.int64, len(plains))
    tokens = kind.tokens(kind.between.join(p for p in plains if p))
    return tokens, samples(kind, kind.numbers(tokens)), np.cumsum(n) - n, np.maximum(n - kind.width + 1, 0)


def extractor(kind) -> Extract:
    def extract(texts: list[str]) -> list[tuple[bytes, np.ndarray]]:
        plains = [kind.plain(t.encode("utf-8", "surrogatepass")) for t in texts]
        _, marks, first, windows = sampled(kind, plains)
        out = []
        for plain, a, n in zip(plains, first.tolist(), windows.tolist()):
            own = marks[a:a + n]
            if n > 1:
                own = np.unique(own[np.r_[True, own[1:] != own[:-1]]])
            out.append((text_key(plain), own))
        return out
    return extract


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


@dataclass
class Block:
    """Runs of windows of some documents: the run's document, first window and number of windows; their tokens."""

    ids: np.ndarray
    parts: list[bytes]
    doc: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    tokens: Tokens

    def pack(self) -> bytes:
        return squeeze(pickle.dumps((self.ids, self.parts, self.doc, self.first, self.windows, self.tokens.raw)))

    @staticmethod
    def unpack(raw: bytes, kind) -> Block:
        *rest, plain = pickle.loads(unsqueeze(raw))
        return Block(*rest, kind.tokens(plain))

    def places(self, kind) -> tuple[np.ndarray, np.ndarray]:
        """For each window its place in ``tokens`` and its run."""
        run = np.repeat(np.arange(len(self.windows)), self.windows)
        return np.arange(len(run)) + run * (kind.width - 1), run

    def only(self, flags: np.ndarray, kind) -> Block:
        """The runs of flagged windows."""
        place, run = self.places(kind)
        starts, ends = stretches(flags)
        if len(starts):  # a stretch ends where its run does
            inner = np.flatnonzero(flags[1:] & flags[:-1] & (run[1:] != run[:-1])) + 1
            starts, ends = np.sort(np.r_[starts, inner]), np.sort(np.r_[ends, inner])
        own = run[starts]
        begin = np.cumsum(self.windows) - self.windows
        plain = kind.between.join(self.tokens.pieces(place[starts], place[starts] + (ends - starts) + kind.width - 1))
        return Block(self.ids, self.parts, self.doc[own], self.first[own] + starts - begin[own], ends - starts, kind.tokens(plain))


def _to_blocks(batches: Iterator[pa.RecordBatch], kind, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Candidates (``doc_id, text, text_key, marks``) -> blocks."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held: list = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, size, number
        doc = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
        block = Block(np.array([h[0] for h in held], np.int64), [h[1] for h in held], doc, np.concatenate([h[2] for h in held]),
                      np.concatenate([h[3] for h in held]), Tokens(kind.between.join(p for h in held for p in h[4])))
        out = pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "data": [block.pack()],
                                          "n": pa.array([int(block.windows.sum())], pa.int64())})
        held, size, number = [], 0, number + 1
        return out

    for batch in batches:
        ids, parts, found = (batch.column(i).to_pylist() for i in (0, 2, 3))
        texts = ((i, t.as_py()) for i, t in enumerate(batch.column(1)))
        for rows, some in slices(texts):
            plains = [kind.plain(t.encode("utf-8", "surrogatepass")) for t in some]
            tokens, marks, first, windows = sampled(kind, plains)
            for i, plain, a, n in zip(rows, plains, first.tolist(), windows.tolist()):
                if not n or text_key(plain) != parts[i]:
                    continue
                starts, ends = stretches(np.isin(marks[a:a + n], np.frombuffer(b"".join(found[i]), np.uint64)))
                pieces = tokens.pieces(a + starts, a + ends + kind.width - 1)
                held.append((ids[i], parts[i], starts, ends - starts, pieces))
                size += sum(map(len, pieces))
                if size >= block_bytes:
                    yield flush()
    if held:
        yield flush()


# ---- step 3: windows that more than one document has

def _window_hashes(block: Block, kind) -> tuple[np.ndarray, np.ndarray]:
    place, run = block.places(kind)
    x = gram_hashes(kind.numbers(block.tokens), kind.width, strong=False)
    return (x[place] >> np.uint64(16) if len(place) else np.empty(0, np.uint64)), run


def _send_hashes(batches: Iterator[pa.RecordBatch], kind, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block = Block.unpack(raw, kind)
            h, run = _window_hashes(block, kind)
            doc = block.ids[block.doc[run]]
            by = np.argsort(h, kind="stable")
            h, doc = h[by], doc[by]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, int)
            several = np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start) if len(h) else np.empty(0, bool)
            h = h[start]
            bucket = ((h >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(full, pa.int32()), "block": pa.array([number] * len(full), pa.int64()),
                "hashes": pa.array([np.ascontiguousarray(h[cut[b]:cut[b + 1]].view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes() for b in full], pa.binary()),
                "several": pa.array([np.packbits(several[cut[b]:cut[b + 1]]).tobytes() for b in full], pa.binary())})


def _meet_hashes(rows: pa.Table) -> pa.Table:
    bucket, parts, flags, sizes = rows["bucket"][0].as_py(), [], [], []
    for raw, several in zip(rows["hashes"].to_pylist(), rows["several"].to_pylist()):
        n = len(raw) // 6
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(6, -1).T
        parts.append(wide.view(np.uint64).ravel()), sizes.append(n)
        flags.append(np.unpackbits(np.frombuffer(several, np.uint8), count=n).astype(bool))
    h, several = np.concatenate(parts), np.concatenate(flags)
    by = np.argsort(h, kind="stable")
    start = np.flatnonzero(np.r_[True, h[by][1:] != h[by][:-1]])
    n = np.diff(np.r_[start, len(h)])
    shared = np.empty(len(h), bool)
    shared[by] = np.repeat((n > 1) | np.logical_or.reduceat(several[by], start), n)
    ends = np.cumsum(sizes)
    return pa.table({"block": rows["block"], "bucket": pa.array([bucket] * len(sizes), pa.int32()), "n": pa.array(sizes, pa.int32()),
                     "flags": pa.array([np.packbits(shared[e - s:e]).tobytes() for s, e in zip(sizes, ends)], pa.binary())})


def _refine(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, raw, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            block = Block.unpack(raw, kind)
            h, _ = _window_hashes(block, kind)
            own, which = np.unique(h, return_inverse=True)
            found.sort(key=lambda r: r["bucket"])
            flags = np.concatenate([np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=r["n"]) for r in found]).astype(bool)
            if len(flags) != len(own):
                raise ValueError("a block and its flags differ")
            left = block.only(flags[which], kind)
            if len(left.windows):
                yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "data": [left.pack()],
                                                  "n": pa.array([int(left.windows.sum())], pa.int64())})


# ---- step 4: groups of the exact method

class Method:
    """How a kind of windows is split into groups and solved. ``levels``: growing lengths of what a group's
    windows have in common."""

    levels: list[int]

    def common(self, x: np.ndarray, level: int, kind) -> np.ndarray:
        """A hash of what each window (by its place in ``x``) has in common with the others of its group."""
        raise NotImplementedError

    def items(self, block: Block, place: np.ndarray, run: np.ndarray, group: np.ndarray, common: np.ndarray, kind):
        """(items as bytes, answers per item, smallest id per item, group per item, for each window its item and answer in it)"""
        raise NotImplementedError

    def answers_of(self, item: bytes, kind) -> int:
        """Number of an item's windows."""
        return 1

    def solve(self, items: list[bytes], ids: np.ndarray, kind) -> np.ndarray:
        """For each window of each item the smallest id of its window over all items."""
        raise NotImplementedError


def groups_of(block: Block, method: Method, heavy: dict[int, set[int]], groups: int, kind, upto: int | None = None):
    """Each window's group: at the first level whose bin is not heavy (the last level takes all). Also the hashes."""
    place, run = block.places(kind)
    x = kind.numbers(block.tokens)
    group, common = np.full(len(place), -1, np.int64), np.zeros(len(place), np.uint64)
    for n, level in enumerate(method.levels if upto is None else method.levels[:upto + 1]):
        open_ = group < 0
        if not open_.any():
            break
        c = method.common(x, level, kind)[place[open_]]
        bins = (((mix(c + np.uint64(n)) >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)
        fits = ~np.isin(bins, list(heavy.get(n, ()))) if n + 1 < len(method.levels) else np.ones(len(bins), bool)
        at = np.flatnonzero(open_)[fits]
        group[at], common[at] = (n << 32) + bins[fits], c[fits]
    return place, run, group, common


def _loads(batches: Iterator[pa.RecordBatch], method: Method, heavy: dict, groups: int, kind, level: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: dict[int, int] = {}
        for raw in batch.column(0).to_pylist():
            _, _, group, _ = groups_of(Block.unpack(raw, kind), method, heavy, groups, kind, level)
            found, n = np.unique(group[group >> 32 == level], return_counts=True)
            for g, k in zip(found.tolist(), n.tolist()):
                total[g] = total.get(g, 0) + k
        yield pa.RecordBatch.from_pydict({"grp": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})


def find_heavy(blocks: DataFrame, method: Method, groups: int, kind, limit: int) -> dict[int, set[int]]:
    """Level -> bins over ``limit`` (at most ``groups`` small integers a level)."""
    heavy: dict[int, set[int]] = {}
    for level in range(len(method.levels) - 1):
        known = dict(heavy)
        loads = (blocks.select("data").mapInArrow(lambda it, k=known, v=level: _loads(it, method, k, groups, kind, v), "grp long, n long")
                 .groupBy("grp").agg(F.sum("n").alias("n")).where(F.col("n") > limit).select("grp").collect())
        if not loads:
            break
        heavy[level] = {r["grp"] & 0xFFFFFFFF for r in loads}
    return heavy


def _send_items(batches: Iterator[pa.RecordBatch], method: Method, heavy: dict, groups: int, kind) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block = Block.unpack(raw, kind)
            items, _, ids, of, _, _ = method.items(block, *groups_of(block, method, heavy, groups, kind), kind)
            by = np.argsort(of, kind="stable")
            cut = np.flatnonzero(np.r_[True, of[by][1:] != of[by][:-1], True]) if len(by) else np.zeros(1, int)
            spans = list(zip(cut[:-1], cut[1:]))
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array([int(of[by[a]]) for a, _ in spans], pa.int64()), "block": pa.array([number] * len(spans), pa.int64()),
                "items": pa.array([squeeze(pickle.dumps([items[i] for i in by[a:z]])) for a, z in spans], pa.binary()),
                "ids": pa.array([squeeze(planes(ids[by[a:z]])) for a, z in spans], pa.binary())})


def _solve_group(rows: pa.Table, method: Method, kind) -> pa.Table:
    items, ids, sizes = [], [], []
    for raw, own in zip(rows["items"].to_pylist(), rows["ids"].to_pylist()):
        part = pickle.loads(unsqueeze(raw))
        items += part
        sizes.append(len(part)), ids.append(unplaned(unsqueeze(own), "int64"))
    answers = method.solve(items, np.concatenate(ids), kind)
    ends = np.cumsum(np.r_[0, [method.answers_of(x, kind) for x in items]])
    out, at = [], 0
    for n in sizes:
        out.append(squeeze(planes(answers[ends[at]:ends[at + n]])))
        at += n
    return pa.table({"block": rows["block"], "grp": rows["grp"], "answers": pa.array(out, pa.binary())})


def covered(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans [a, z) that windows with these sorted starts cover."""
    if not len(starts):
        return starts, starts
    new = np.r_[True, starts[1:] > starts[:-1] + width]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return starts[new], starts[last] + width


def _spans(batches: Iterator[pa.RecordBatch], method: Method, heavy: dict, groups: int, kind) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block = Block.unpack(raw, kind)
            place, run, group, common = groups_of(block, method, heavy, groups, kind)
            _, per_item, _, of, item, inside = method.items(block, place, run, group, common, kind)
            found.sort(key=lambda r: r["grp"])
            answers = np.concatenate([unplaned(unsqueeze(r["answers"]), "int64") for r in found])
            by = np.argsort(of, kind="stable")
            at = np.empty(len(by), np.int64)
            at[by] = np.cumsum(per_item[by]) - per_item[by]
            doc = block.doc[run]
            gone = answers[at[item] + inside] < block.ids[doc]
            start = (block.first[run] + np.arange(len(run)) - (np.cumsum(block.windows) - block.windows)[run])[gone]
            doc = doc[gone]
            out: dict[str, list] = {"doc_id": [], "text_key": [], "starts": [], "ends": []}
            edges = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True]) if len(doc) else np.empty(0, int)
            for low, high in zip(edges[:-1], edges[1:]):  # a block's runs are in the order of its documents
                d = doc[low]
                a, z = covered(start[low:high], kind.width)
                out["doc_id"].append(int(block.ids[d])), out["text_key"].append(block.parts[d])
                out["starts"].append(a), out["ends"].append(z)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()),
                                                                    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]))


def find_repeats(spark: SparkSession, docs: DataFrame, kind, method: Method, buckets: int | None = None,
                 block_bytes: int | None = None, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Of ``docs`` (``doc_id`` long, ``text``): ``doc_id, text_key, starts, ends, copy``.

    Spans of tokens that windows with a smaller first id cover; ``copy`` is
    true (and the spans null) where the whole text equals that of a smaller
    id. Documents without either have no row."""
    buckets, block_bytes = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), block_bytes or kind.block_bytes
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    found = stored(spark, shared_marks(named, lambda: extractor(kind), buckets), scratch_path(spark, "repeat-marks"))
    info = found.where("size IS NOT NULL").select("doc_id", "text_key")
    # stored, so that the join below reads a plain shuffle on both sides and a hot key can be split
    first = stored(spark, info.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                   .where("first < last").select("text_key", "first"), scratch_path(spark, "repeat-copies"))
    copies = (info.join(first, "text_key").where("doc_id > first")
              .select("doc_id", "text_key").distinct())
    chosen = merged_marks(found).select("doc_id", "text_key", "marks")
    blocks = stored(spark, named.join(chosen, "doc_id").select("doc_id", "text", "text_key", "marks").mapInArrow(
        lambda it: _to_blocks(it, kind, block_bytes), "block long, data binary, n long"), scratch_path(spark, "repeat-blocks"))
    flags = (blocks.select("block", "data").mapInArrow(lambda it: _send_hashes(it, kind, buckets), "bucket int, block long, hashes binary, several binary")
             .groupBy("bucket").applyInArrow(_meet_hashes, "block long, bucket int, n int, flags binary")
             .groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "flags")).alias("found")))
    left = stored(spark, blocks.join(flags, "block").select("block", "data", "found").mapInArrow(
        lambda it: _refine(it, kind), "block long, data binary, n long"), scratch_path(spark, "repeat-windows"))
    total = left.agg(F.sum("n")).first()[0] or 0
    groups = int(max(buckets, -(-3 * total // (2 * group_windows))))
    heavy = find_heavy(left, method, groups, kind, group_windows)
    answers = (left.select("block", "data").mapInArrow(lambda it: _send_items(it, method, heavy, groups, kind), "grp long, block long, items binary, ids binary")
               .groupBy("grp").applyInArrow(lambda t: _solve_group(t, method, kind), "block long, grp long, answers binary")
               .groupBy("block").agg(F.collect_list(F.struct("grp", "answers")).alias("found")))
    spans = stored(spark, left.join(answers, "block").select("data", "found").mapInArrow(
        lambda it: _spans(it, method, heavy, groups, kind), "doc_id long, text_key binary, starts array<long>, ends array<long>"),
        scratch_path(spark, "repeat-spans"))
    return (spans.withColumn("copy", F.lit(False)).join(copies, ["doc_id", "text_key"], "left_anti")
            .unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True))


def _cut(batches: Iterator[pa.RecordBatch], kind, carried: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"n": [], "n_removed": [], "n_spans": [], "starts": [], "ends": [], "kept": []}
        for text, found in zip(batch.column(carried), batch.column(carried + 1).to_pylist()):
            plain = kind.plain((text.as_py() or "").encode("utf-8", "surrogatepass"))
            n, starts, ends, kept = kind.count(plain), [], [], plain
            if found:
                key = text_key(plain)
                for r in found:
                    if r["text_key"] == key:
                        starts, ends = ([0], [n]) if r["copy"] and n >= kind.width else ([], []) if r["copy"] else (r["starts"], r["ends"])
            if starts:
                edges = np.array([[0, *ends], [*starts, n]], np.int64)
                first, end = edges[:, edges[0] < edges[1]]
                kept = kind.between.join(kind.tokens(plain).pieces(first, end))
            out["n"].append(n), out["n_spans"].append(len(starts)), out["n_removed"].append(sum(ends) - sum(starts))
            out["starts"].append(starts), out["ends"].append(ends), out["kept"].append(kept)
        cols = [pa.array(out[k], pa.int64()) for k in ("n", "n_removed", "n_spans")]
        cols += [pa.array(out[k], pa.list_(pa.int64())) for k in ("starts", "ends")] + [pa.array(out["kept"], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(carried)] + cols,
                                         names=[batch.schema.field(i).name for i in range(carried)]
                                         + ["n", "n_removed", "n_spans", "starts", "ends", "kept"])


def remove_repeats(spark: SparkSession, docs: DataFrame, kind, method: Method, id_col: str, text_col: str,
                   carry: list[str] | None = None, **options) -> DataFrame:
    """One row per document: the ``carry`` columns (default: the id), ``n`` tokens, ``n_removed``, ``n_spans``,
    ``starts``, ``ends`` and ``kept`` (binary; words joined by one space)."""
    carry = [id_col] if carry is None else carry
    found = find_repeats(spark, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), kind, method, **options)
    by_doc = (found.groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "starts", "ends", "copy")).alias("_found"))
              .withColumnRenamed("doc_id", "_of"))
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    joined = rows.join(by_doc, F.col("_id") == F.col("_of"), "left").select(*[f"c{i}" for i in range(len(carry))], "_text", "_found")
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    out = joined.mapInArrow(lambda it: _cut(it, kind, len(carry)),
                            f"{kinds}, n long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept binary")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n", "n_removed", "n_spans", "starts", "ends", "kept")
