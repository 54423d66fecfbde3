from __future__ import annotations

import zlib

import numpy as np
import pytest

ODD = [None, "", "   ", "  a  b\n\nc   ", "Don't it's <|endoftext|>x", "日本語 ☃ \U0001f600x", "a\tb\r\nc\x1cd", "x" * 9000, "12345 don't!!!"]


def test_packing_against_the_tokenizer(spark, corpus, docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    from treatment_lake.llm.packing import pack

    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(ODD))]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    out = pack(spark, docs_of(rows), window=256, grid=4).collect()
    spans, sequences = {i: [] for i in ids}, {}
    for r in out:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        spans[r.doc_id].append((r.start, r.start + r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, s in spans.items():
        s.sort()
        assert s[0][0] == 0 and s[-1][1] == len(ids[i]) and all(a[1] == b[0] for a, b in zip(s, s[1:]))
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and s[-1][0] + s[-1][1] <= 256
    assert sum(r.length for r in out) / (256 * len(sequences)) > 0.95
    assert pack(spark, docs_of([])).collect() == []


def test_packing_repeated_rows_and_null_ids(spark, docs_of):
    from treatment_lake.llm.packing import pack

    out = pack(spark, docs_of([(1, "a b"), (1, "a b"), (None, "a b")]), window=16, grid=2).collect()
    assert len(out) == 3 and sum(r.doc_id is None for r in out) == 1 and len({(r.sequence_id, r.offset) for r in out}) == 3


def test_nnls_and_plan():
    from treatment_lake.llm.packing import combinations, make_plan, slots_of, solve_nnls

    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.normal(size=(6, 9)), rng.normal(size=6)
        x = solve_nnls(a, b)
        g = a.T @ (b - a @ x)
        assert (x >= 0).all() and g.max() < 1e-6 and abs(g @ x) < 1e-6  # optimal by the conditions of the problem
    assert combinations(6, 3) == [(1, 1, 4), (1, 2, 3), (1, 5), (2, 2, 2), (2, 4), (3, 3), (6,)]
    counts = {u: int(n) for u, n in zip(range(1, 33), rng.integers(0, 500, 32))}
    plan = make_plan(counts, 32, 3)
    used = {}
    for classes, times in plan:
        assert sum(classes) <= 32 and times > 0
        for u in classes:
            used[u] = used.get(u, 0) + times
    assert used == {u: n for u, n in counts.items() if n}
    for u in used:
        ranges = sorted((lo, hi) for s, lo, hi, _, _ in slots_of(plan) if s == u)
        assert ranges[0][0] == 0 and ranges[-1][1] == counts[u] and all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))


def test_language_id_held_out_accuracy(spark):
    from treatment_lake.llm.langid import identify

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_id_odd_texts(spark, docs_of):
    from treatment_lake.llm.langid import identify, learn, predict

    out = {r.doc_id: r for r in identify(docs_of([*enumerate(ODD), (None, "hello there"), (50, "hello")])).collect()}
    assert [out[i].lang_pred for i in range(3)] == ["und"] * 3 and out[0].score == 0
    assert out[3].lang_pred == out[7].lang_pred == "en" and out[None].held_out is False
    assert identify(docs_of([])).collect() == []
    nothing = predict(docs_of([(1, "abc")]), learn(docs_of([])))
    assert [(r.lang_pred, r.score) for r in nothing.collect()] == [("und", 0.0)]
    carried = predict(docs_of([(1, "abc")]), learn(docs_of([])), carry=["key", "doc_id"]).collect()[0]
    assert (carried.key, carried.doc_id) == ("clash", 1)


def test_hypervectors_bind_and_bundle():
    """The profile equals the sum over all trigrams of roll(a, 2) * roll(b, 1) * c."""
    from treatment_lake.llm.langid import Space, cosines, trigram_codes

    space = Space(256, 3)
    text = " héllo wörld "
    total = np.zeros(256)
    letters = [space.letter(ord(c)).astype(int) for c in text]
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(a, 2) * np.roll(b, 1) * c
    codes, owner, alphabet = trigram_codes(["HÉLLO 42 wörld!", "..."])
    assert set(owner.tolist()) == {0} and alphabet[0] == 32
    assert (space.trigrams(codes, alphabet).astype(int).sum(axis=0) == total).all()
    model = {"langs": ["x", "y"], "vectors": np.stack([total / np.linalg.norm(total), np.ones(256) / 16]), "dims": 256, "seed": 3}
    cos = cosines(["HÉLLO 42 wörld!", "..."], model, space)
    assert cos[0, 0] == pytest.approx(1) and np.isnan(cos[1]).all()


def test_sentencepiece_against_the_library(spark, corpus, docs_of):
    import sentencepiece

    from treatment_lake.llm.sentencepiece_fst import _model_path, decode, encode

    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(ODD)), (2000, "▁▁a ▁"), (None, "x")]
    model = sentencepiece.SentencePieceProcessor(model_file=_model_path(None))
    texts = dict(rows)
    coded = encode(docs_of(rows))
    out = coded.collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == model.encode((texts[r.doc_id] or "").replace("▁", " ")) and r.round_trip and r.n_ids == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    back = {r.doc_id: r.text for r in decode(coded).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in rows}
    assert encode(docs_of([])).collect() == []


def test_transducer_path_is_the_only_allowed_one():
    from treatment_lake.llm.sentencepiece_fst import Transducer

    machine = Transducer()

    def paths(word):
        if not word:
            return [[]]
        return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in machine.weight or n == 1 for rest in paths(word[n:])]

    for word in ("▁hello", "▁théo", "ation", "▁▁▁x"):
        allowed = [p for p in paths(word) if all(machine.follows(a, b) for a, b in zip(p, p[1:]))
                   and all(machine.merged(x) == [x] for x in p)]
        assert allowed == [machine.path(word)]
