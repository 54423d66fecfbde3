from __future__ import annotations

from . import brute


def test_stages_against_brute_force(spark, corpus, scratch):
    """Every stage on what the stage before kept; all but the last keep the columns of documents."""
    import corpus_pipeline

    rows = corpus
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    texts = dict(rows)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(name)
        out = stage(spark, docs, "")
        out.write.parquet(path)
        docs_before, docs = docs, spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == docs_before.columns
            after[name] = {r.doc_id: r.text for r in docs.collect()}
    letters = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert after["language_id"] == letters
    kept = {i: t for i, t in letters.items() if brute.exact_groups(letters.items())[i][2]}
    assert after["exact_dedup"] == kept
    classes = brute.jaccard_classes(kept.items())
    near = {i: t for i, t in kept.items() if classes[i][1] == i}
    assert after["near_dedup"] == near and len(near) < len(kept)
    cut = brute.removed_windows(near.items(), 13, True)
    assert after["substring_dedup"] == {i: cut[i][3].decode() if cut[i][1] else t for i, t in near.items()}
    assert {r.doc_id for r in docs.collect()} == set(near)


def test_entry_has_the_operators():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert {"op5_exact_dedup", "op10_exact_topk"} <= set(entry.oracle_sql())


def test_language_stage_without_labels_keeps_texts_with_letters(spark):
    import corpus_pipeline

    rows = [(1, "a clean text", None), (2, "日本語", None), (3, "12 34 !", None), (4, "", None), (5, None, None), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.language_id(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.text for r in out.collect()) == sorted([rows[0][1], rows[1][1], rows[5][1]])
