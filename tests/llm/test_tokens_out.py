"""Token files: Elias-Fano boundaries, pre-tokens, exact round trips."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_elias_fano_selects_what_was_encoded():
    from treatment_lake.llm.elias_fano import EliasFano, encode

    rng = np.random.default_rng(3)
    for n, most in ((0, 1), (1, 0), (1, 10 ** 6), (1000, 3), (1000, 10 ** 9), (5000, 5000), (3000, 2 ** 62), (700, 0)):
        values = np.sort(rng.integers(0, most + 1, n).astype(np.uint64))
        raw = b"xx" + encode(values) + b"yy"
        code = EliasFano(raw, 2)
        assert code.size == len(raw) - 4 and code.run(0, n).tolist() == values.tolist()
        for i in rng.integers(0, n, 60).tolist() if n else ():
            assert code.select(i) == int(values[i])
        for a, z in np.sort(rng.integers(0, n + 1, (20, 2)), axis=1).tolist():
            assert code.run(a, z).tolist() == values[a:z].tolist()
    ends = np.cumsum(rng.integers(50, 900, 50_000)).astype(np.uint64)
    assert len(encode(ends)) < 50_000 * 12 / 8 + 50_000 / 256 * 4 + 100  # about 2 + log2(475) bits each, not 64
    with pytest.raises(ValueError):
        encode(np.array([2, 1]))


def test_piece_store_tells_words_apart_by_bytes(monkeypatch):
    from treatment_lake.llm import piece_store

    def solve(words):
        ids = [np.frombuffer(w, np.uint8).astype(np.uint32) for w in words]
        return np.concatenate(ids), np.array([len(x) for x in ids])

    rnd = random.Random(2)
    for most, hashed in ((100_000, piece_store.mix), (60, piece_store.mix), (100_000, lambda x: x % np.uint64(5))):
        monkeypatch.setattr(piece_store, "mix", hashed)
        store = piece_store.PieceStore(solve, most)
        for _ in range(20):
            words = [bytes(rnd.choices(b"ab\0", k=rnd.choice([1, 2, 3, 15, 16, 17, 40, 80]))) for _ in range(400)]
            ends = np.cumsum([len(w) for w in words])
            ids, before = store.of(b"".join(words), np.r_[0, ends[:-1]], ends)
            assert bytes(ids.astype(np.uint8)) == b"".join(words) and before[1:].tolist() == ends.tolist()


PARTS = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "\r\n", "'s", "'t", "'re", "'ve", "'ll", "'m", "'d", "'S", "'", "''", "1", "23", "½", "!",
         "?#", "日本", "☃", "\u0085", "\x1c", "\x00", "😀", "ğ", "́", "٣", "Ⅷ", "ǅ", "᠎", "​", "﻿", "ა", "Ა", "\U0001e900",
         "'l", "'lle", "'reS", "n't", "<|endoftext|>"]


def test_ids_are_the_tokenizers_own(tokenizer):
    import public_tokenizers

    from treatment_lake.llm.token_files import ByteLevelIds, parts_of

    ids = ByteLevelIds(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    for turn in range(150):
        some = PARTS[:30] if turn % 3 else PARTS
        texts = ["".join(rnd.choices(some, k=rnd.randint(0, 30))) for _ in range(40)]
        for text, got in zip(texts, ids.of(texts)):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    long = "ab cd, 12  " * 400_000
    parts = parts_of(long)
    assert len(parts) > 2 and "".join(parts) == long
    assert sum(len(x) for x in ids.of(parts)) == len(tokenizer.encode(long, add_special_tokens=False).ids)


def expected(rows, tokenizer):
    out, at = {}, 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        at += len(ids)
    return out


def test_round_trip_through_files(spark, corpus, docs_of, tokenizer, scratch):
    from treatment_lake.llm.token_files import Segment, manifest, read_tokens, write_tokens

    rows = [*corpus, (None, "no id"), (-7, "below zero"), (10 ** 15, "far\n\nabove")]
    want = expected(rows, tokenizer)
    for shard, segment in ((16_000_000, 8_000_000), (8000, 700)):
        path = scratch("tokens")
        write_tokens(spark, docs_of(rows), path, shard_bytes=shard, segment_tokens=segment)
        out = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, np.frombuffer(r.ids, "<u4").tolist()) for r in read_tokens(spark, path).collect()}
        assert out == want
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
        for raw in (bytes(f.content) for f in files):
            held = Segment(raw)
            for i in range(held.docs):
                assert held.document(i).tolist() == want[held.doc_id(i)][3]
        named = manifest(spark, path).collect()
        assert len(named) == len(files) and (segment > 1000 or len(named) > 10)
        assert sum(m.tokens for m in named) == sum(n for _, n, _, _ in want.values())


def test_hot_ids_repeated_rows_and_empty_table(spark, docs_of, tokenizer, scratch):
    from treatment_lake.llm.token_files import manifest, read_tokens, write_tokens

    rows = [(5, "the same row")] * 40 + [(5, "another text of five")] * 3 + [(1, None), (1, "")] + [(9, "x")]
    path = scratch("tokens")
    write_tokens(spark, docs_of(rows), path, shard_bytes=60, segment_tokens=15)
    out = read_tokens(spark, path, with_ids=False).orderBy("start").collect()
    assert [r.doc_id for r in out] == [1, 1] + [5] * 43 + [9]
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist()
    assert out[0].n_tokens == out[1].n_tokens == 1 and len({m.shard for m in manifest(spark, path).collect()}) > 3  # one id, several tasks
    path = scratch("tokens")
    write_tokens(spark, docs_of(rows).limit(0), path)
    assert read_tokens(spark, path).collect() == []


def test_query_on_the_whole_table(spark, tokenizer):
    from treatment_lake.llm.token_files import op11_token_files

    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    out = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op11_token_files(spark, "/root/testdata/sf0.001").collect()}
    assert out == {k: v[:3] for k, v in expected(docs, tokenizer).items()}
