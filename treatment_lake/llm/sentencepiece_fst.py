"""SentencePiece encoding and decoding as a weighted transducer (operator 4).

Three machines are compiled from the model file and composed with each text:

- the normaliser: a blank before the text, every blank becomes U+2581;
- pieces: an acceptor whose arcs spell a piece, weighted by minus its score;
  a two-piece machine rides on it, whose weight is 0 if the second piece may
  follow the first and infinite if the merges of the model would have joined
  across their border (a sequence is the model's own exactly when all its
  neighbours are allowed);
- byte fallback: a character without a piece becomes the pieces of its bytes.

The shortest path in the tropical semiring is the only one of finite weight:
at most one such path reaches a place, whose state is the piece that ends
there. Between two characters that no piece has side by side the machine
passes its start state, so texts are cut there, and the parts (words, in
the main) are solved once and remembered. Decoding is the inverse machine.

Each text is encoded where it is read; nothing moves.

Defined results
- null text: like the empty text, no ids;
- very long texts and words: whole; repeated rows: one result each;
- U+2581 in a text decodes to a blank (the normaliser merges the two);
- empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .marks import slices
from .piece_store import PieceStore
from .registry import bounded_batches, query, table
from .worker import memo

BLANK = "▁"
BLANK_BYTES = BLANK.encode()
STORED = 1_000_000  # words whose ids a worker looks up; forgotten when full
WORDS = 500_000  # solved words that a worker remembers; cleared when full


def _model_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


class Memo(dict):
    """Remembers what ``solve`` makes of a string; cleared when full."""

    def __init__(self, solve):
        self.solve = solve

    def __missing__(self, key: str) -> bytes:
        out = self.solve(key)
        if len(key) <= 64:
            if len(self) >= WORDS:
                self.clear()
            self[key] = out
        return out


class Transducer:
    """The composed machine; ids are little-endian uint32 bytes."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=_model_path(path))
        n = model.get_piece_size()
        self.text, self.byte, self.weight, self.ids = [b""] * n, [0] * 256, {}, {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
                self.text[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.weight[piece] = -model.get_score(i)
                self.text[i] = piece.encode()
        for piece in self.ids:
            if BLANK in piece.lstrip(BLANK):
                raise ValueError(f"piece {piece!r} has a blank after another character")
        # characters that some piece has side by side; between two others every path passes the start state
        self.inside = {piece[i:i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.trie: dict = {}  # arcs by character; "" holds the piece that ends at a node
        for piece in self.ids:
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece
        sizes = np.array([len(t) for t in self.text])
        self.spelling, self.sizes, self.begin = np.frombuffer(b"".join(self.text), np.uint8), sizes, np.cumsum(sizes) - sizes
        self.lines = not any("\n" in piece for piece in self.ids)
        self.allowed: dict[tuple[str, str], bool] = {}
        self.parts = Memo(self.solve)  # strings without a cut
        self.store = PieceStore(self.learn, STORED)

    # ---- the two-piece machine

    def merged(self, text: str) -> list[str]:
        """The model's merges on a short text: always the lightest piece, the leftmost of equals."""
        parts, weight = list(text), self.weight
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                w = weight.get(parts[i] + parts[i + 1])
                if w is not None and (best is None or w < best):
                    best, at = w, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, first: str, second: str) -> bool:
        key = (first, second)
        ok = self.allowed.get(key)
        if ok is None:
            if len(self.allowed) >= WORDS:
                self.allowed.clear()
            self.allowed[key] = ok = self.merged(first + second) == [first, second]
        return ok

    # ---- shortest path

    def arcs(self, word: str, at: int) -> Iterator[str]:
        """Pieces that start here, longest first; a character without a piece stands for its bytes."""
        node, found = self.trie, []
        for i in range(at, len(word)):
            node = node.get(word[i])
            if node is None:
                break
            if "" in node:
                found.append(node[""])
        if not found or len(found[0]) > 1:
            found.insert(0, word[at])
        return reversed(found)

    def path(self, word: str) -> list[str]:
        """Pieces of the one path of finite weight through ``word``.

        Depth first along the arcs, longest first. A place is reached by one path only, so a place that leads
        nowhere is never tried again."""
        n, allowed, out, dead, at = len(word), self.allowed, [], set(), 0
        open_arcs = [self.arcs(word, 0)]
        while at < n:
            for piece in open_arcs[-1]:
                if at + len(piece) in dead:
                    continue
                if out:
                    ok = allowed.get((out[-1], piece))
                    if not (self.follows(out[-1], piece) if ok is None else ok):
                        continue
                out.append(piece)
                at += len(piece)
                open_arcs.append(self.arcs(word, at) if at < n else iter(()))
                break
            else:
                dead.add(at)
                open_arcs.pop()
                at -= len(out.pop())
        return out

    def solve(self, word: str) -> bytes:
        ids: list[int] = []
        for piece in self.path(word):
            if piece in self.ids:
                ids.append(self.ids[piece])
            else:
                ids += [self.byte[b] for b in piece.encode("utf-8", "surrogatepass")]
        return np.array(ids, dtype="<u4").tobytes()

    def by_parts(self, text: str) -> bytes:
        """``text`` cut between characters that no piece has side by side."""
        inside = self.inside
        cuts = [i + 1 for i in range(len(text) - 1) if text[i:i + 2] not in inside]
        if not cuts:
            return self.parts[text]
        return b"".join([self.parts[text[a:z]] for a, z in zip([0, *cuts], [*cuts, len(text)])])

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.by_parts(w.decode("utf-8", "surrogatepass").replace(" ", BLANK)) for w in words]
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts are cut before every run of blanks and every line feed, where paths part too."""
        raws = [(" " + t.replace(BLANK, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        raw = b"".join(raws)
        if not raw:
            return [b""] * len(texts)
        x = np.frombuffer(raw, np.uint8)
        text_starts = np.cumsum([0, *map(len, raws)])
        begins = x == 32
        begins[1:] &= x[:-1] != 32  # a run of blanks stays with the word after it
        if self.lines:
            begins |= x == 10
        begins[text_starts[:-1][np.array([len(r) > 0 for r in raws])]] = True
        starts = np.flatnonzero(begins)
        found, before = self.store.of(raw, starts, np.r_[starts[1:], len(raw)])
        ids = found.astype("<u4").tobytes()
        cuts = (4 * before[np.searchsorted(starts, text_starts)]).tolist()
        return [ids[a:z] for a, z in zip(cuts, cuts[1:])]

    def decode(self, ids: bytes) -> str:
        """The normalised text with its blanks back and the one in front taken off."""
        own = np.frombuffer(ids, "<u4")
        n = self.sizes[own]
        before = np.cumsum(n) - n
        raw = self.spelling[np.repeat(self.begin[own] - before, n) + np.arange(int(n.sum()))].tobytes()
        text = raw.replace(BLANK_BYTES, b" ").decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


def _encode(batches: Iterator[pa.RecordBatch], path: str | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    machine: Transducer = memo(("sentencepiece", path), lambda: Transducer(path))
    for batch in batches:
        n, crc, same, lists = [], [], [], []
        coded = ((t, ids) for _, some in slices(enumerate(x.as_py() or "" for x in batch.column(1))) for t, ids in zip(some, machine.encode(some)))
        for text, ids in coded:
            n.append(len(ids) // 4), crc.append(zlib.crc32(ids))
            same.append(machine.decode(ids) == text.replace(BLANK, " "))
            if with_ids:
                lists.append(np.frombuffer(ids, dtype="<u4").astype(np.int32))
        cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
        names = ["doc_id", "n_ids", "ids_crc32", "round_trip"]
        if with_ids:
            cols.append(pa.array(lists, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(cols, names=names)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           with_ids: bool = True) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, round_trip`` and, if asked for, ``ids``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(lambda it: _encode(it, model, with_ids),
                           f"doc_id {kind}, n_ids long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids)


def _decode(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    machine: Transducer = memo(("sentencepiece", path), lambda: Transducer(path))
    for batch in batches:
        texts = [machine.decode(np.array(x.as_py() or [], dtype="<u4").tobytes()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``doc_id, text`` of ids (null: the empty text)."""
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        lambda it: _decode(it, model), f"doc_id {kind}, text string")


@query("op4_sentencepiece_fst")
def op4_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), with_ids=False)
