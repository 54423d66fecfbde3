"""Token ids as binary files with Elias-Fano document boundaries (operator 11).

The format. A data set is a folder of segment files in ascending document
order, ``shard=S/segment=G/docs=M/tokens=T/part-*``: the order is that of
(S, G), and the names carry the counts, so the place of a segment among all
ids is known from a listing. A file holds, little-endian,

    8 bytes TOKSEG01, uint32 bytes of an id (2 or 4), uint32 documents without an id, uint64 documents, uint64 ids,
    int64 smallest document id, the Elias-Fano code of the document ids (less the smallest),
    the Elias-Fano code of the documents' ends, all ids in a row, a line feed

so a document's place is two ``select`` calls, and no table of 64-bit offsets
is kept. Files are written by Spark's own writer (a lost executor's task is
done again, and its commit decides which file counts) and read with its
``binaryFile`` source: any store that Spark reads will do.

The way. Texts are dealt into ranges of (document id, row) of bounded size -
rows with one id may fall into several ranges - and each task turns its range
into segments. Tokens are looked up by pre-token (``PieceStore``); only those not
seen before go to the tokenizer. The boundaries of pre-tokens are found with
array operations where all characters are old enough to be in every Unicode
table; other texts go to the tokenizer whole.

Defined results
- null or empty text: the end id alone;
- null document ids come first; rows that share an id, or come twice, are
  documents of their own, next to each other;
- very long texts: whole, cut for the tokenizer only where a letter, a blank
  and a letter meet, which is always a border;
- empty table: no file, empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .elias_fano import EliasFano, encode
from .piece_store import PieceStore
from .registry import bounded_batches, query, table
from .worker import memo

MAGIC = b"TOKSEG01"
HEAD = "<8sIIQQq"
HEAD_SIZE = struct.calcsize(HEAD)
SLICE = 1_000_000  # characters looked at together
REMEMBERED = 800_000  # pre-tokens whose ids a worker remembers
AT_ONCE = 10_000  # pre-tokens in one call of the tokenizer
MOST_SHARDS = 20_000  # tasks that write; beyond, each writes several segments
READ_AT_ONCE = 65_536  # documents whose boundaries are decoded together

BLANK, SPACE, LETTER, NUMBER, OTHER, BORDER, NEWER = range(7)
CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def kinds_of_characters() -> np.ndarray:
    """By code point: what the pre-tokenizer takes a character for; NEWER where that depends on the Unicode version."""
    old = unicodedata.ucd_3_2_0
    out = np.full(0x110000, NEWER, np.uint8)
    for code in range(0x30000):
        c = chr(code)
        kind = old.category(c)
        if kind == unicodedata.category(c) and kind != "Cn":
            out[code] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else SPACE if kind[0] == "Z" else OTHER
    out[[9, 10, 11, 12, 13, 0x85]] = SPACE  # white space without being separators
    out[32] = BLANK
    out[0xD800:0xE000] = NEWER
    out[0x180E] = NEWER  # was a separator once
    return out


def pre_tokens(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pre-tokens start. Kinds BORDER stand between texts and are pieces of their own.

    Runs of letters, of numbers and of other signs, each with one blank before it; of white space before something
    else the last sign is apart; an apostrophe that starts a piece takes s, t, re, ve, m, ll or d with it."""
    n = len(kind)
    white = kind <= SPACE
    before = np.r_[np.uint8(BORDER), kind[:-1]]
    after = np.r_[kind[1:], np.uint8(BORDER)]
    white_before, white_after = before <= SPACE, after <= SPACE
    run = ~white & (kind != before)
    start = run & (before != BLANK)
    start |= white & ~white_before
    start |= white & ~white_after & (after != BORDER)
    start |= kind == BORDER
    start |= before == BORDER
    mark = np.flatnonzero((codes == 39) & run & (before != BLANK) & (after == LETTER))
    if len(mark):
        one = codes[mark + 1]
        two = codes[np.minimum(mark + 2, n - 1)]
        long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        taken = np.where((one == 115) | (one == 116) | (one == 109) | (one == 100), 1, np.where(long, 2, 0))
        hit = taken > 0
        start[mark[hit] + 1] = False
        rest = mark[hit] + 1 + taken[hit]
        start[rest[rest < n]] = True
    return np.flatnonzero(start)


class ByteLevelIds:
    """Ids of whole texts, many at a time, equal to the tokenizer's own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special, self.between = list(special), next(iter(special.items()), (None, None))
        self.kinds = kinds_of_characters()
        self.store = PieceStore(self.learn, REMEMBERED)

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens in few calls, a special token between them."""
        content, mark = self.between
        parts, counts = [], []
        for a in range(0, len(words), AT_ONCE):
            some = [w.decode() for w in words[a:a + AT_ONCE]]
            if content is None:
                each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                parts.append(np.concatenate([np.array(x, np.uint32) for x in each]))
                counts.append(np.array([len(x) for x in each], np.int64))
                continue
            ids = np.array(self.tokenizer.encode_batch_fast([content.join(some)], add_special_tokens=False)[0].ids, np.uint32)
            real = ids != mark
            cuts = np.r_[-1, np.flatnonzero(~real), len(ids)]
            parts.append(ids[real])
            counts.append(np.diff(cuts) - 1)
        return np.concatenate(parts), np.concatenate(counts)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[i] = self.whole(t)
            else:
                plain.append(i)
        joined = "\0".join(texts[i] for i in plain)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kinds[codes]
        sizes = np.array([len(texts[i]) for i in plain], np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        if (kind == NEWER).any():
            newer = np.unique(np.searchsorted(first, np.flatnonzero(kind == NEWER), side="right") - 1).tolist()
            for k in newer:
                out[plain[k]] = self.whole(texts[plain[k]])
            rest = [i for k, i in enumerate(plain) if k not in set(newer)]
            for i, ids in zip(rest, self.of([texts[i] for i in rest]) if rest else ()):
                out[i] = ids
            return out
        if not plain:
            return out
        kind[first[1:] - 1] = BORDER
        start = pre_tokens(codes, kind)
        raw = joined.encode()
        at = start if len(raw) == len(codes) else np.r_[0, np.cumsum(1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800)
                                                                       + (codes >= 0x10000))][start]
        ends = np.r_[at[1:], len(raw)]
        real = kind[start] != BORDER if len(start) else np.zeros(0, bool)
        ids, before = self.store.of(raw, at[real], ends[real])
        cut = before[np.searchsorted(start[real], np.r_[first, len(codes) + 1])]
        for i, a, z in zip(plain, cut.tolist(), cut[1:].tolist()):
            out[i] = ids[a:z]
        return out


def parts_of(text: str) -> list[str]:
    """A long text in parts of about SLICE characters, cut where pre-tokens always meet."""
    out, at = [], 0
    while len(text) - at > 2 * SLICE:
        cut = CUT.search(text, at + SLICE)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def slices(texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """(row, part of its text) in runs of about SLICE characters."""
    out, size = [], 0
    for row, text in enumerate(texts):
        for part in parts_of(text or ""):
            if out and size + len(part) > SLICE:
                yield out
                out, size = [], 0
            out.append((row, part))
            size += len(part)
    if out:
        yield out


def _vocabulary(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return path


def encoded(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids with the end id) of rows ``doc_id, text``."""
    words = memo(("byte level", path), lambda: ByteLevelIds(_vocabulary(path)))
    kind = np.dtype("<u4" if words.wide or end_id >= 1 << 16 else "<u2")
    end = np.array([end_id], kind)
    for batch in batches:
        names, open_row, chunks = batch.column(0).to_pylist(), 0, []
        for some in slices(batch.column(1).to_pylist()):
            for (row, _), ids in zip(some, words.of([t for _, t in some])):
                if row != open_row:
                    yield names[open_row], np.concatenate([*chunks, end])
                    open_row, chunks = row, []
                chunks.append(ids.astype(kind))
        if names:
            yield names[open_row], np.concatenate([*chunks, end])


def segment(doc_ids: list[int | None], ends: np.ndarray, ids: list[np.ndarray]) -> bytes:
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    above = (known.astype(np.uint64) - np.uint64(least % 2 ** 64)) if len(known) else np.empty(0, np.uint64)
    return b"".join([struct.pack(HEAD, MAGIC, ids[0].itemsize, len(doc_ids) - len(known), len(doc_ids), int(ends[-1]), least),
                     encode(above), encode(ends.astype(np.uint64)), *(x.tobytes() for x in ids), b"\n"])


def _segments(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of (doc_id, row) -> segment files of about ``most`` ids; a longer document is alone."""
    shard, nth = TaskContext.get().partitionId(), 0
    doc_ids, lengths, ids, held = [], [], [], 0

    def row() -> pa.RecordBatch:
        blob = segment(doc_ids, np.cumsum(lengths), ids)
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "segment": pa.array([nth], pa.int32()),
                                           "docs": pa.array([len(doc_ids)], pa.int64()), "tokens": pa.array([held], pa.int64()),
                                           "blob": pa.array([blob], pa.binary())})
    for doc_id, own in encoded(batches, path, end_id):
        if doc_ids and held + len(own) > most:
            yield row()
            doc_ids, lengths, ids, held, nth = [], [], [], 0, nth + 1
        doc_ids.append(doc_id), lengths.append(len(own)), ids.append(own)
        held += len(own)
    if doc_ids:
        yield row()


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                 vocab: str | None = None, shard_bytes: int = 8_000_000, segment_tokens: int = 4_000_000) -> None:
    """Writes the ids of all documents, in ascending id order, to a fresh folder of segment files."""
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(MOST_SHARDS, 1 + total // shard_bytes)
    order = [F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    (rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(shards, *order).sortWithinPartitions(*order)
     .select("doc_id", "text").mapInArrow(lambda it: _segments(it, vocab, end_id, segment_tokens),
                                          "shard int, segment int, docs long, tokens long, blob binary")
     .select("shard", "segment", "docs", "tokens", F.col("blob").cast("string").alias("value"))
     .write.partitionBy("shard", "segment", "docs", "tokens").option("lineSep", "\n").text(path))


def segment_files(spark: SparkSession, path: str) -> DataFrame:
    """``content`` and what the names say of every segment file; a data set without documents has none."""
    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:
        return spark.createDataFrame([], "content binary, shard int, segment int, docs long, tokens long")
    return files.select("content", *(F.col(c).cast(k).alias(c) for c, k in (("shard", "int"), ("segment", "int"), ("docs", "long"), ("tokens", "long"))))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``shard, segment, docs, tokens, first_id`` of every segment, from the files' names: no content is read. The sums
    run within a shard, then over the shards (at most ``MOST_SHARDS`` rows)."""
    named = segment_files(spark, path).drop("content")
    upto = [Window.unboundedPreceding, -1]
    shards = named.groupBy("shard").agg(F.sum("tokens").alias("t")).select(
        "shard", F.coalesce(F.sum("t").over(Window.orderBy("shard").rowsBetween(*upto)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("tokens").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(*upto)), F.lit(0))
    return (named.withColumn("inside", inside).join(shards, "shard")
            .select("shard", "segment", "docs", "tokens", (F.col("base") + F.col("inside")).alias("first_id")))


class Segment:
    """A segment file in memory: documents are found by ``select`` on their ends."""

    def __init__(self, raw: bytes):
        magic, self.width, self.unnamed, self.docs, self.tokens, self.least = struct.unpack_from(HEAD, raw)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.names = EliasFano(raw, HEAD_SIZE)
        self.ends = EliasFano(raw, HEAD_SIZE + self.names.size)
        self.ids = np.frombuffer(raw, f"<u{self.width}", self.tokens, HEAD_SIZE + self.names.size + self.ends.size)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.unnamed else self.least + self.names.select(i - self.unnamed)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]

    def all(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, its first id's place in the segment, its ids); boundaries are decoded in runs."""
        at = 0
        for a in range(0, self.docs, READ_AT_ONCE):
            z = min(self.docs, a + READ_AT_ONCE)
            known = self.names.run(max(a - self.unnamed, 0), max(z - self.unnamed, 0)).tolist()
            names = [None] * (z - a - len(known)) + [self.least + x for x in known]
            for name, end in zip(names, self.ends.run(a, z).tolist()):
                yield name, at, self.ids[at:end]
                at = end


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    kinds = {"shard": pa.int32(), "segment": pa.int32(), "doc_id": pa.int64(), "at": pa.int64(), "n_tokens": pa.int64(),
             "ids_crc32": pa.int64(), "ids": pa.binary()}

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds.values())], names=list(kinds))

    for batch in batches:
        for shard, part, raw in zip(*(batch.column(i) for i in range(3))):
            rows, size = [], 0
            for doc_id, at, ids in Segment(raw.as_py()).all():
                le = ids.astype("<u4").tobytes()
                rows.append((shard.as_py(), part.as_py(), doc_id, at, len(ids), zlib.crc32(le), le if with_ids else None))
                size += 64 + (len(le) if with_ids else 0)
                if size > 1 << 23:
                    yield made(rows)
                    rows, size = [], 0
            if rows:
                yield made(rows)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, with ``with_ids``, ``ids`` (little-endian uint32) from the files;
    ``start`` is the number of ids of all documents before it."""
    bounded_batches(spark)
    docs = segment_files(spark, path).select("shard", "segment", "content").mapInArrow(
        lambda it: _read(it, with_ids), "shard int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long, ids binary")
    first = manifest(spark, path).select("shard", "segment", "first_id")
    out = docs.join(first, ["shard", "segment"]).withColumn("start", F.col("first_id") + F.col("at"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


@query("op11_token_files")
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(spark, table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, with_ids=False)
