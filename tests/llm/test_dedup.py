from __future__ import annotations

import hashlib

from . import brute


def test_exact_dedup_against_brute_force(spark, corpus, docs_of):
    from treatment_lake.llm.exact_dedup import exact_dedup

    want = brute.exact_groups(corpus)
    for key_hex in (64, 1):  # one hex digit: digests clash, the byte check tells texts apart
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(spark, docs_of(corpus), key_hex=key_hex).collect()}
        assert got == want


def test_exact_dedup_ties_nulls_and_empty(spark, docs_of):
    from treatment_lake.llm.exact_dedup import exact_dedup, keep_rows

    rows = [(7, "Same"), (7, "same"), (None, "SAME"), (None, "alone"), (3, None), (4, "")]
    docs = docs_of(rows)
    out = exact_dedup(spark, docs).collect()
    same = [r for r in out if r.text_sha256 == hashlib.sha256(b"same").hexdigest()]
    assert len(same) == 3 and {r.keep_id for r in same} == {7} and {r.group_size for r in same} == {3} and sum(r.kept for r in same) == 1
    assert [(r.keep_id, r.kept) for r in out if r.text_sha256 == hashlib.sha256(b"alone").hexdigest()] == [(None, True)]
    assert {r.doc_id: r.kept for r in out if r.text_sha256 == hashlib.sha256(b"").hexdigest()} == {3: False, 4: True}
    assert keep_rows(docs, exact_dedup(spark, docs)).columns == docs.columns
    assert exact_dedup(spark, docs.limit(0)).collect() == []


def test_exact_dedup_of_later_arrivals(spark, docs_of, scratch):
    from treatment_lake.llm.exact_dedup import exact_dedup

    def call(rows, **options):
        return {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(spark, docs_of(rows), **options).collect()}

    first, second, third = [(1, "a"), (2, "b"), (3, "B"), (4, None)], [(5, "A"), (6, "c"), (0, "b"), (7, "")], [(6, "C"), (9, "d")]
    for key_hex in (64, 1, 0):  # with no digit all texts meet in one digest
        folder = scratch("arrivals")
        assert call(first, work_dir=folder, key_hex=key_hex) == {1: (1, 1, True), 2: (3, 2, False), 3: (3, 2, True), 4: (4, 1, True)}
        # judged with what came before: 5 takes over from 1, 0 does not from 3
        assert call(second, work_dir=folder, key_hex=key_hex) == {5: (5, 2, True), 6: (6, 1, True), 0: (3, 3, False), 7: (7, 2, True)}
        # a tie on the identifier: the later call's row
        assert call(third, work_dir=folder, key_hex=key_hex) == {6: (6, 2, True), 9: (9, 1, True)}
        assert call([], work_dir=folder, key_hex=key_hex) == {}
        state = spark.read.parquet(f"{folder}/texts")
        assert state.count() == 3 + 4 + 2
    assert call(second) == {5: (5, 1, True), 6: (6, 1, True), 0: (0, 1, True), 7: (7, 1, True)}


def test_exact_dedup_plan_is_native(spark, docs_of):
    from treatment_lake.llm.exact_dedup import exact_dedup

    plan = exact_dedup(spark, docs_of([(1, "a"), (2, "A")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_jaccard_against_brute_force(spark, corpus, docs_of):
    from treatment_lake.llm.jaccard_join import jaccard_components

    want = brute.jaccard_classes(corpus)
    docs = docs_of(corpus)
    for options in ({}, {"small_up_to": 12, "unit_marks": 200}, {"small_up_to": 0}):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark, docs, **options).collect()}
        assert got == want, options


def test_jaccard_nulls_repeats_and_empty(spark, docs_of):
    from treatment_lake.llm.jaccard_join import jaccard_components

    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (9, "A B C D E F"), (5, None), (6, "")]
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(spark, docs_of(rows)).collect()), key=str)
    assert out == [(2, 2, 2), (2, 2, 2), (5, 0, 5), (6, 0, 6), (9, 2, 2), (None, 2, None)]
    assert jaccard_components(spark, docs_of(rows).limit(0)).collect() == []


def test_jaccard_keys_that_clash_in_their_first_bytes(spark, corpus, docs_of, monkeypatch):
    from treatment_lake.llm import jaccard_join

    real = jaccard_join.extractor

    def clashing(k):
        extract = real(k)
        return lambda texts: [(b"clash!" + key[6:], own) for key, own in extract(texts)]

    monkeypatch.setattr(jaccard_join, "extractor", clashing)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark, docs_of(corpus)).collect()}
    assert got == brute.jaccard_classes(corpus)


def test_jaccard_repeated_rows_in_different_partitions(spark):
    from treatment_lake.llm.jaccard_join import jaccard_components

    whole = " ".join(f"w{i}" for i in range(44))
    half = " ".join([f"w{i}" for i in range(25)] + [f"x{i}" for i in range(19)])  # 21 of 40 shingles are the other's
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(1, whole), (1, whole), (2, half), (2, half)], 4), "doc_id long, text string")
    assert docs.rdd.glom().map(len).collect() == [1, 1, 1, 1]
    out = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(spark, docs).collect())
    assert out == [(1, 40, 1), (1, 40, 1), (2, 40, 2), (2, 40, 2)]


def test_jaccard_small_set_keys_and_boundary():
    from itertools import combinations

    from treatment_lake.llm.jaccard_join import boundary, needed, prefix_length, subset_keys

    for a in range(1, 15):
        for b in range(a, 15):
            for both in range(1, a + 1):
                links = 100 * both >= 75 * (a + b - both)
                assert links == (both >= needed(a, b, 75))
                if links:
                    assert both > a - prefix_length(a, 75) and (a, b, needed(a, b, 75)) in set(subset_keys(a, 75)) & set(subset_keys(b, 75))
    assert boundary({3: (10, 1), 8: (10, 1)}, 75) == 0  # short lists: scanning is cheaper
    assert boundary({3: (10, 10_000), 8: (10, 100_000)}, 75) >= 8
    assert len(list(combinations(range(8), needed(8, 8, 75)))) == 8


def test_link_group_with_groups_known_before():
    import numpy as np

    from treatment_lake.llm.jaccard_join import link_group

    marks = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 1, 2, 40, 41)]
    ids, sizes = np.arange(5) * 10, np.full(5, 20)
    edges = link_group(ids, sizes, marks, np.array([0, 1, 0, 3, 4]), 75)
    assert len(edges) == 2  # 0 and 2 are one group already


def test_components(spark):
    from treatment_lake.llm.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200), (300, 7)] + [(500, k) for k in range(501, 540)]
    frame = spark.createDataFrame(edges, "a long, b long")
    out = {r.node: r.component for r in components(spark, frame).collect()}
    assert out == {r.node: r.component for r in components(spark, frame, one_task=0).collect()}  # in rounds
    want = {i: 0 for i in [*range(41), 300]} | {100: 100, 101: 100, 103: 100} | {k: 500 for k in range(500, 540)}
    assert out == want
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def _removed(out):
    return {r.doc_id: (r.n, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}


def test_suffix_trees_against_brute_force(spark, corpus, docs_of):
    from treatment_lake.llm.suffix_trees import substring_dedup

    rows = [*corpus, (None, corpus[1][1])]
    want = brute.removed_windows(rows, 13, True)
    for options in ({}, {"group_windows": 20, "block_bytes": 500}):
        assert _removed(substring_dedup(spark, docs_of(rows), **options)) == want, options
    assert substring_dedup(spark, docs_of([]), carry=["doc_id", "lang"]).collect() == []


def test_suffix_sort_against_brute_force(spark, corpus, docs_of):
    from treatment_lake.llm.suffix_sort import suffix_dedup

    rows = [*corpus, (None, corpus[1][1])]
    want = brute.removed_windows(rows, 50, False)
    for options in ({}, {"group_windows": 100, "block_bytes": 2000}):
        assert _removed(suffix_dedup(spark, docs_of(rows), **options)) == want, options


def test_repeated_rows_stay(spark, docs_of):
    from treatment_lake.llm.suffix_trees import substring_dedup

    text = " ".join(f"w{i}" for i in range(30))
    out = sorted((r.doc_id, r.n_removed) for r in substring_dedup(spark, docs_of([(1, text), (1, text), (2, text)])).collect())
    assert out == [(1, 0), (1, 0), (2, 30)]


def test_repeats_of_texts_whose_keys_begin_alike(spark, docs_of):
    from treatment_lake.llm.repeats import text_key
    from treatment_lake.llm.suffix_sort import suffix_dedup
    from treatment_lake.llm.suffix_trees import substring_dedup

    passage = "the same passage of more than thirteen words stands in both of these texts so that its windows are shared "
    pairs = [(6843128, 31371571), (30419554, 36864888)]  # found by trying 48 million numbers
    rows = [(i, passage + str(n)) for i, n in enumerate(n for pair in pairs for n in pair)]
    keys = [text_key(t.encode()) for _, t in rows]
    assert len(set(keys)) == 4 and len({k[:6] for k in keys}) == 2
    for of in (rows, rows[:2]):  # alone, the two texts of a pair meet in nobody else
        assert _removed(substring_dedup(spark, docs_of(of))) == brute.removed_windows(of, 13, True)
        assert _removed(suffix_dedup(spark, docs_of(of))) == brute.removed_windows(of, 50, False)


def test_two_stage_sort():
    import random

    import numpy as np

    from treatment_lake.llm.suffix_sort import BORDER, two_stage_sort

    rnd = random.Random(2)
    for _ in range(150):
        x = [rnd.randint(0, rnd.choice([1, 2, 25])) for _ in range(rnd.randint(1, 200))] * rnd.choice([1, 3])
        x = np.array([*x, BORDER], np.uint8)
        if len(x) > 9:
            x[rnd.randrange(len(x))] = BORDER
        text, depth = x.tobytes(), rnd.choice([3, 8, 13, 50])
        order = two_stage_sort(x, depth)
        assert sorted(order.tolist()) == list(range(len(x)))
        heads = [text[i:i + depth].partition(b"\xff")[:2] for i in order]
        assert heads == sorted(heads, key=b"".join)


def test_suffix_tree_nodes():
    import random

    from treatment_lake.llm.suffix_trees import common_words, suffix_tree

    rnd = random.Random(3)
    for _ in range(100):
        n = rnd.randint(1, 30)
        suffixes = sorted(b" ".join(rnd.choice([b"a", b"b"]) for _ in range(4)) for _ in range(n))
        ids = [rnd.randint(0, 99) for _ in range(n)]
        want = {}
        for i in range(n):
            for j in range(i + 1, n):
                d = common_words(suffixes[i].split(), suffixes[j].split())
                if d:
                    members = [m for m in range(n) if common_words(suffixes[m].split(), suffixes[i].split()) >= d]
                    want[d, members[0], members[-1] + 1] = min(ids[m] for m in members)
        for least in (1, 3, 4):
            assert {(d, a, z): m for d, a, z, m in suffix_tree(suffixes, ids, 4, least)} == {k: m for k, m in want.items() if k[0] >= least}
