from __future__ import annotations

import math
import random

from . import brute


def test_top_k_against_brute_force(spark):
    from pyspark.sql import functions as F

    from treatment_lake.llm.topk import top_k

    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(400, 440)]  # ties
    rows += [(500, None), (501, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (502, [math.nan] * 6), (503, [math.inf] * 6), (None, [0.1] * 6), (550, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, shard string")
    import numpy as np

    exact = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute.top_k(exact, lambda q: q % 50 == 0, 5)
    for shard_rows, block_rows, leaf in ((8192, 1024, 128), (40, 3, 4)):
        out = top_k(spark, df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=block_rows, leaf_size=leaf)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect()) == want
    assert top_k(spark, df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    few = top_k(spark, df.where("vec_id in (50, 51)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(50, 51)]


def test_top_k_repeated_rows_and_large_components(spark):
    from pyspark.sql import functions as F

    from treatment_lake.llm.topk import top_k

    rows = [(0, [1e6, -1e6]), (1, [1e6, 1e6]), (1, [1e6, 1e6]), (2, [-1e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = top_k(spark, df, F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in out) == [(1, 1, 0), (2, 2, -2 * 256_000_000 ** 2)]


def test_top_k_with_empty_shards_and_one_id_for_many_rows(spark):
    from pyspark.sql import functions as F

    from treatment_lake.llm.topk import top_k

    rnd = random.Random(11)
    rows = [(i % 4, [rnd.randint(-300, 300) / 256 for _ in range(3)]) for i in range(62)] + [(100, [0.5, 0.25, -1.0]), (150, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows, block_rows in ((1, 1), (1, 2), (7, 1), (8192, 1024)):
        out = top_k(spark, df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=block_rows)
        got = sorted((r.query_id, r["rank"], r.score) for r in out.collect())
        want = []
        for q, v in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
            scores = sorted((-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)) for c, w in {(i, tuple(v)) for i, v in rows} if c != q))
            want += [(q, n + 1, -s) for n, s in enumerate(scores[:5])]
        assert got == sorted(want), (shard_rows, block_rows)
    hot = [(7, [rnd.uniform(-1, 1), rnd.uniform(-1, 1)]) for _ in range(10_000)] + [(0, [1.0, -0.5]), (50, [-1.0, 0.25])]
    df = spark.createDataFrame(hot, "vec_id long, embedding array<double>")
    out = top_k(spark, df, F.col("vec_id") % 50 == 0, shard_rows=1000, block_rows=1).collect()
    for q, v in hot[-2:]:
        exact = sorted((sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)) for c, w in {(i, tuple(w)) for i, w in hot} if c != q), reverse=True)
        assert [r.score for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] == exact[:5]


def test_known_words_of_any_length_are_segments(spark):
    from treatment_lake.llm.url_filter import judge

    word = "donaudampfschifffahrtsgesellschaft"
    df = spark.createDataFrame([(1, f"http://die{word}.org/fr/", f"<p>{(word + ' die ') * 51}</p>"), (2, "http://" + "q" * 90 + ".net/", None)],
                               "page_id long, url string, html string")
    out = {r.page_id: r.host_words for r in judge(spark, df).collect()}
    assert out[1][:2] == ["die", word] and out[2][0] == "q" * 90


def test_kd_tree_boxes_hold_their_points():
    import numpy as np

    from treatment_lake.llm.topk import build_tree

    rng = np.random.default_rng(0)
    ids, points = np.arange(500), rng.integers(-50, 50, (500, 5))
    tree = build_tree(ids, points, 16)
    assert sorted(tree["ids"].tolist()) == ids.tolist() and (points[tree["ids"]] == tree["points"]).all()
    for (a, b), low, high, least in zip(tree["leaves"], tree["low"], tree["high"], tree["least"]):
        assert b - a <= 16 and (low == tree["points"][a:b].min(0)).all() and (high == tree["points"][a:b].max(0)).all() and least == tree["ids"][a:b].min()


URLS = [(1, "http://a.b.NET/x"), (2, "https://net/"), (3, "http://net"), (4, "http://www.example.net/en/5?q#f"), (5, "http://example.com/de/1"),
        (6, "http://blog.example.com/fr/"), (7, "ftp://x.org/fr/a#b"), (8, "http://x.org/en/a"), (9, "no scheme"), (10, None), (11, "a://"),
        (12, "http://fooorg/fr/"), (13, "x://h?://net/"), (14, "http://goodwords.example.com/en/1"), (15, "http://cheappills.example.com/en/2"),
        (None, "http://x.net/"), (4, "http://www.example.net/en/5?q#f"), (16, "http://cheappills.net/z"), (17, "http://goodwords.org/fr/9"),
        (18, "http://" + "ab" * 400 + ".com/")]


def test_url_rules_and_method(spark):
    from treatment_lake.llm.url_filter import judge

    html = "<p>cheap pills cheap pills good words good words</p><script>bad()</script>"
    df = spark.createDataFrame([(i, u, html if i != 1 else None, "x") for i, u in URLS], "page_id long, url string, html string, host string")
    rows = judge(spark, df).collect()
    assert len(rows) == len(URLS)
    out = {r.page_id: r for r in rows}
    want = {1: ("a.b.net", "/x", "net/", "block"), 2: ("net", "/", "net/", "block"), 4: ("www.example.net", "/en/5", "example.net/en/", "allow"),
            5: ("example.com", "/de/1", "example.com/de/", "block"), 7: ("x.org", "/fr/a", "org/fr/", "allow")}
    for i, w in want.items():
        assert (out[i].host, out[i].path, out[i].rule, out[i].verdict) == w
    for i, host, path in ((3, "net", ""), (9, "", ""), (10, "", ""), (11, "", ""), (12, "fooorg", "/fr/"), (13, "h", "")):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, None) and out[i].verdict in ("block", "allow")
    assert out[14].host_words[:2] == ["good", "words"] and out[15].host_words[:2] == ["cheap", "pills"]
    assert out[15].verdict == "block" and out[14].score < out[15].score
    assert "".join(out[18].host_words) == "ab" * 400 + "com"
    assert judge(spark, df.limit(0)).collect() == []


def test_viterbi_is_the_best_split():
    from itertools import product

    from treatment_lake.llm.url_filter import viterbi

    counts, total = {"the": 50, "rap": 4, "ist": 2, "therapist": 5, "th": 1, "era": 3, "pist": 1}, 200.0
    word = "therapist"
    known = {(i, j): math.log(counts[word[i:j]] / total) for i in range(9) for j in range(i + 1, 10) if word[i:j] in counts}

    def score(cuts):
        at, s = [0, *[i + 1 for i, c in enumerate(cuts) if c], 9], 0.0
        for a, b in zip(at, at[1:]):
            s += known.get((a, b), math.log(10 / total) - (b - a) * math.log(10))
        return s, [word[a:b] for a, b in zip(at, at[1:])]

    assert viterbi(word, known, total) == max(score(c) for c in product((0, 1), repeat=8))[1]


def test_quality_on_labels_and_shrinkage(spark):
    from treatment_lake.llm.quality import score

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = score(spark, docs, labels).join(labels.withColumnRenamed("quality", "y").select("doc_id", "y"), "doc_id").collect()
    assert sum(r.kept == (r.y == 1) for r in out) / len(out) > 0.97
    assert all(r.kept for r in out if r.y == 1)


def test_quality_shrinks_sparse_sites(spark):
    from treatment_lake.llm.quality import score

    rnd = random.Random(1)
    rows, marks = [], []
    for i in range(600):
        host = "big" if i < 300 else f"h{i % 20}"
        good = int(rnd.random() < (0.9 if host == "big" else (i % 20) / 20))
        rows.append((i, "word " * 20, "en", host))
        marks.append((i, good))
    rows += [(900, "word " * 20, "en", "lone"), (901, None, None, None), (901, None, None, None), (None, "", "en", "big")]
    marks += [(900, 0), (None, 1), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = {(r.doc_id, r.host): r for r in score(spark, docs, labels).collect()}
    mean = sum(q for i, q in marks[:601] if q is not None) / 601
    assert 0 < out[900, "lone"].p_host < mean  # pulled from 0 towards the global rate
    assert abs(out[0, "big"].p_host - 0.9) < 0.06
    assert len(out) == len(rows) - 1 and all(0 <= r.quality <= 1 for r in out.values())
    assert score(spark, docs.limit(0), labels).collect() == []
    assert {round(r.p_doc, 6) for r in score(spark, docs, labels.limit(0)).collect()} == {0.5}
