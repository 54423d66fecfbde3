"""Words that are alike in their structure: nothing takes them for one another."""

from __future__ import annotations

import zlib

import numpy as np


def thue_morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out[:n]


ONE = thue_morse(2048)
OTHER = ONE.translate(str.maketrans("ab", "ba"))


def test_hashes_of_complementary_words_differ():
    from treatment_lake.llm.marks import piece_hashes

    for n in (4, 8, 16, 17, 64, 1024, 2048):
        raw = (ONE[:n] + OTHER[:n]).encode()
        a, b = piece_hashes(raw, np.array([0, n]), np.array([n, 2 * n])).tolist()
        assert a != b
    words = ["", "a", "aa", "a\0", "\0", "\0\0"] + ["ab" * k for k in range(1, 40)]
    ends = np.cumsum([len(w) for w in words])
    assert len(set(piece_hashes("".join(words).encode(), ends - [len(w) for w in words], ends).tolist())) == len(words)


def test_ids_of_complementary_words_are_their_own(spark, docs_of):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from treatment_lake.llm.packing import pack
    from treatment_lake.llm.sentencepiece_fst import encode

    rows = [(1, ONE), (2, OTHER), (3, f"{ONE} {OTHER}"), (4, f"{OTHER} {ONE} {ONE[:16]} {OTHER[:16]}")]
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = {r.doc_id: r.ids_crc32 for r in pack(spark, docs_of(rows, 1)).where("start = 0 AND length = doc_tokens").collect()}
    for i, text in rows:
        ids = words.encode(text, add_special_tokens=False).ids + [1]
        if len(ids) <= 2048:
            assert out[i] == zlib.crc32(np.array(ids, "<u4").tobytes())
    coded = {r.doc_id: r.ids for r in encode(docs_of(rows, 1)).collect()}
    assert coded == {i: pieces.encode(t) for i, t in rows}


def test_a_word_of_a_megabyte_is_encoded_in_time():
    import time

    import public_tokenizers

    from treatment_lake.llm.sentencepiece_fst import Transducer

    machine = Transducer(public_tokenizers.path("piece_bpe_32k.model"))
    start = time.time()
    text = "ab" * 500_000
    assert machine.decode(machine.encode([text])[0]) == text
    assert time.time() - start < 60


def test_documents_of_complementary_words_are_not_linked(spark, docs_of):
    from treatment_lake.llm.jaccard_join import jaccard_components

    rows = [(1, ONE[:1024]), (2, OTHER[:1024]), (3, " ".join([ONE[:1024]] * 9 + ["x"])), (4, " ".join([OTHER[:1024]] * 9 + ["x"]))]
    out = {r.doc_id: r.component_id for r in jaccard_components(spark, docs_of(rows)).collect()}
    assert out == {1: 1, 2: 2, 3: 3, 4: 4}
