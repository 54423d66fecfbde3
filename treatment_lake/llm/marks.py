"""Which marks of a document occur in other documents too.

A mark is a 64-bit hash of something in a text (a shingle, a k-gram chosen by
a rule that depends on its surroundings only). ``shared_marks`` finds, for
every document, those of its marks that some document with another text has.
It is the candidate stage of the joins and substring operators here.

One pass over the texts: a worker gathers the marks of many documents, folds
equal texts into the one with the smallest id, cuts the marks into buckets
by value and sends one row per bucket. A bucket is a range of uniform
hashes, so a mark that a third of all documents have weighs no more in it
than one entry per worker batch and different text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .piece_store import MASKS, mix
from .registry import bounded_batches

FLUSH = 1_000_000  # marks that a worker gathers before it sends them
AT_ONCE = 500_000  # marks of a bucket that are compared at once
SCHEMA = "doc_id long, text_key binary, size long, marks binary, counts binary"

#: texts -> for each a 16-byte key of what counts as the same text and its distinct marks
Extract = Callable[[list[str]], list[tuple[bytes, np.ndarray]]]
SLICE = 1_000_000  # characters handled at once


def slices(texts: Iterable[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of (row, text) of about SLICE characters; a longer text is alone."""
    rows, out, size = [], [], 0
    for row, text in texts:
        if out and size + len(text) > SLICE:
            yield rows, out
            rows, out, size = [], [], 0
        rows.append(row), out.append(text)
        size += len(text)
    if out:
        yield rows, out


def gram_hashes(x: np.ndarray, k: int, strong: bool = True) -> np.ndarray:
    """One hash for each run of ``k`` neighbours in ``x`` (uint64).

    Not ``strong``: half the work, for hashes that only choose candidates."""
    if len(x) < k:
        return np.empty(0, dtype=np.uint64)
    stir = mix if strong else lambda h: h
    whole, size, out, done, factor = x, 1, None, 0, 0xD6E8FEB86659FD93
    while True:  # by doubling: hashes of 1, 2, 4, ... neighbours; those in k's binary form are joined
        if k & size:
            out = whole if out is None else stir(out[:len(out) - size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + whole[done:])
            done += size
        if size * 2 > k:
            return mix(out)
        whole = stir(whole[:-size] * np.uint64(factor) + whole[size:])
        factor = (factor * 0xC2B2AE3D27D4EB4F) % 2 ** 64
        size *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` neighbours."""
    size, low = 1, x
    while size * 2 <= w:
        low = np.minimum(low[:len(low) - size], low[size:])
        size *= 2
    rest = w - size
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


SHORT = 16  # bytes of a piece that two integers hold


def piece_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each piece of ``raw``: up to 16 bytes and the length are mixed as integers, no two such pieces by a
    structure of their letters alone; longer ones go to xxh3."""
    size = ends - starts
    words = np.ndarray((len(raw) + SHORT,), "<u8", buffer=raw + bytes(2 * SHORT), strides=(1,))
    lo = words[starts] & MASKS[np.minimum(size, 8)]
    hi = words[starts + 8] & MASKS[np.clip(size - 8, 0, 8)]
    tag = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = mix(mix(mix(lo + tag) ^ hi) + np.uint64(0xD6E8FEB86659FD93))
    long = np.flatnonzero(size > SHORT)
    if len(long):
        out[long] = [xxhash.xxh3_64_intdigest(raw[a:z]) for a, z in zip(starts[long].tolist(), ends[long].tolist())]
    return out


def planes(x: np.ndarray) -> bytes:
    """Integers by byte position: neighbours are alike, so the shuffle compresses them."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplaned(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _send(ids: list[int], keys: list[bytes], marks: list[np.ndarray], buckets: int, turn: int) -> pa.RecordBatch:
    owner_ids = np.array(ids, dtype=np.int64)
    order = np.argsort(owner_ids, kind="stable")
    sizes = np.array([len(marks[i]) for i in order], dtype=np.int64)
    all_marks = np.concatenate([marks[i] for i in order])
    owner = np.repeat(np.arange(len(ids), dtype=np.uint32), sizes)
    bucket = (((all_marks >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")  # documents stay in order within a bucket
    all_marks, owner = all_marks[by], owner[by]
    cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
    owner_ids = owner_ids[order]
    all_keys = np.frombuffer(b"".join(keys[i] for i in order), dtype=np.uint8).reshape(-1, 16)
    out: dict[str, list] = {"bucket": [], "ids": [], "texts": [], "n": [], "marks": [], "info": []}

    def row(b: int, a: int, z: int, info: bytes | None) -> None:
        mine, n = np.unique(owner[a:z], return_counts=True)
        out["bucket"].append(b), out["info"].append(info)
        out["ids"].append(planes(np.diff(owner_ids[mine], prepend=0)))
        out["texts"].append(all_keys[mine].tobytes())
        out["n"].append(planes(n.astype(np.uint32))), out["marks"].append(planes(all_marks[a:z]))

    info = owner_ids.tobytes() + all_keys.tobytes() + sizes.tobytes()
    for b in range(buckets):
        mine = info if b == turn % buckets else None
        if cuts[b + 1] > cuts[b] or mine is not None:
            row(b, cuts[b], cuts[b + 1], mine)
    return pa.RecordBatch.from_pydict(out, schema=pa.schema(
        [("bucket", pa.int32()), *((k, pa.binary()) for k in ("ids", "texts", "n", "marks", "info"))]))


def _spread(batches: Iterator[pa.RecordBatch], make_extract: Callable[[], Extract], buckets: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    extract, turn = make_extract(), TaskContext.get().partitionId() * 7919
    ids, keys, marks, seen, held = [], [], [], {}, 0
    copies: list[tuple[int, bytes, int]] = []
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        texts = ((i, t.as_py() or "") for i, t in enumerate(batch.column(1)))
        for doc_id, (key, own) in ((doc_ids[i], x) for rows, some in slices(texts) for i, x in zip(rows, extract(some))):
            at = seen.get(key)
            if at is not None:  # equal texts: the smallest id goes on, the others only report their key
                doc_id, ids[at] = max(doc_id, ids[at]), min(doc_id, ids[at])
                copies.append((doc_id, key, len(own)))
                continue
            seen[key] = len(ids)
            ids.append(doc_id), keys.append(key), marks.append(own)
            held += len(own)
            if held >= FLUSH:
                yield _send(ids, keys, marks, buckets, turn)
                ids, keys, marks, seen, held, turn = [], [], [], {}, 0, turn + 1
    if ids:
        yield _send(ids, keys, marks, buckets, turn)
    for at in range(0, len(copies), 100_000):
        part = copies[at:at + 100_000]
        info = (np.array([c[0] for c in part], np.int64).tobytes() + b"".join(c[1] for c in part)
                + np.array([c[2] for c in part], np.int64).tobytes())
        empty = planes(np.empty(0, np.uint64))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([(turn + 1 + at) % buckets], pa.int32()), "ids": [empty], "texts": [b""],
                                          "n": [empty], "marks": [empty], "info": [info]}, schema=pa.schema(
            [("bucket", pa.int32()), *((k, pa.binary()) for k in ("ids", "texts", "n", "marks", "info"))]))


def _several(raws: list, counts: list[np.ndarray], speaks: np.ndarray, rounds: int, turn: int) -> tuple[np.ndarray, ...]:
    """Marks (of one round) that more than one speaking document has: mark, document, how many have it."""
    marks, owners, base = [], [], 0
    for raw, n in zip(raws, counts):
        mark = unplaned(raw, "uint64")
        owner = np.repeat(np.arange(base, base + len(n), dtype=np.int32), n)
        mine = speaks[owner] & (mark % np.uint64(rounds) == turn)
        marks.append(mark[mine]), owners.append(owner[mine])
        base += len(n)
    mark, owner = np.concatenate(marks), np.concatenate(owners)
    by = np.argsort(mark, kind="stable")
    mark, owner = mark[by], owner[by]
    start = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]]) if len(mark) else np.empty(0, int)
    times = np.diff(np.r_[start, len(mark)])
    count = np.repeat(times.astype(np.uint32), times)
    several = count > 1
    return mark[several], owner[several], count[several]


def _meet(rows: pa.Table) -> pa.Table:
    """One bucket: the marks that occur in two different texts or more, by document."""
    out: dict[str, list] = {"doc_id": [], "text_key": [], "size": [], "marks": [], "counts": []}
    docs, texts, counts, raws = [], [], [], []
    for i in range(rows.num_rows):
        raw = {k: rows[k][i] for k in ("ids", "texts", "n", "marks", "info")}
        n = unplaned(raw["n"].as_buffer(), "uint32")
        docs.append(np.cumsum(unplaned(raw["ids"].as_buffer(), "int64")))
        texts.append(np.frombuffer(raw["texts"].as_buffer(), np.uint64).reshape(-1, 2))
        counts.append(n), raws.append(raw["marks"].as_buffer())
        info = raw["info"].as_py()
        if info:
            k = len(info) // 32
            out["doc_id"] += np.frombuffer(info, np.int64, k).tolist()
            out["text_key"] += [info[8 * k + 16 * i:8 * k + 16 * i + 16] for i in range(k)]
            out["size"] += np.frombuffer(info, np.int64, k, 24 * k).tolist()
    out["marks"], out["counts"] = [None] * len(out["doc_id"]), [None] * len(out["doc_id"])
    doc, text = (np.concatenate(x) if x else np.empty(0, k) for x, k in ((docs, np.int64), (texts, np.uint64)))
    if len(doc):
        # one entry, of the smallest document, speaks for equal texts (a repeated row has several entries)
        by_text = np.lexsort((doc, text[:, 0], text[:, 1]))
        near = text[by_text]
        first = np.r_[True, (near[1:] != near[:-1]).any(axis=1)]
        speaks = np.zeros(len(doc), bool)
        speaks[by_text[first]] = True
        # a bucket's marks are compared in rounds of about AT_ONCE, so that its size bounds memory only by its bytes
        rounds = 1 + sum(r.size for r in raws) // 8 // AT_ONCE
        found = [_several(raws, counts, speaks, rounds, turn) for turn in range(rounds)]
        mark, owner, count = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(owner, kind="stable")
        mark, owner, count = mark[by], owner[by], count[by]
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, int)
        for a, z in zip(start, np.r_[start[1:], len(owner)]):
            out["doc_id"].append(int(doc[owner[a]])), out["text_key"].append(text[owner[a]].tobytes()), out["size"].append(None)
            out["marks"].append(mark[a:z].tobytes()), out["counts"].append(count[a:z].tobytes())
    return pa.table(out, schema=pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("size", pa.int64()),
                                           ("marks", pa.binary()), ("counts", pa.binary())]))


def shared_marks(docs: DataFrame, make_extract: Callable[[], Extract], buckets: int) -> DataFrame:
    """Of ``docs`` (``doc_id`` long and not null, ``text``) two kinds of rows:

    - ``doc_id, text_key, size`` for each document (size: number of its marks);
    - ``doc_id, text_key, marks, counts`` in several parts, for one document of each text (the smallest id): its marks that
      other texts have (uint64) and in how many texts each occurs (uint32).
    """
    bounded_batches(docs.sparkSession)
    sent = docs.select("doc_id", "text").mapInArrow(
        lambda it: _spread(it, make_extract, buckets),
        "bucket int, ids binary, texts binary, n binary, marks binary, info binary")
    return sent.groupBy("bucket").applyInArrow(_meet, SCHEMA)


def merged_marks(found: DataFrame) -> DataFrame:
    """The second kind of rows with the parts of a document together: ``doc_id, text_key, marks, counts`` (arrays of binary)."""
    return (found.where("marks IS NOT NULL").groupBy("doc_id", "text_key")
            .agg(F.collect_list(F.struct("marks", "counts")).alias("p"))
            .select("doc_id", "text_key", F.col("p.marks").alias("marks"), F.col("p.counts").alias("counts")))
