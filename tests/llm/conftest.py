from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows: copies, near copies, shared passages, odd and empty texts."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    passage, hot = prose(60), prose(20)
    rows, base = [], prose(120)
    for i in range(90):
        words = prose(rnd.randint(1, 160))
        if i % 6 == 1:
            at = rnd.randint(0, len(words))
            words[at:at] = passage
        if i % 3 == 0:
            words += hot + hot
        if i % 10 == 4:
            words = list(base)
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = "edit%d" % rnd.randrange(50)
        rows.append((i, " ".join(words)))
    rows += [(100, rows[3][1]), (101, rows[3][1].upper()), (102, None), (103, ""), (104, "   \n\t "), (105, "One two three"),
             (106, "one TWO  three"), (107, "a b c d e f g h"), (108, "a b c d e f g x"), (109, "ab " * 300), (110, "ab " * 200),
             (111, "x" * 5000), (112, "x" * 4000 + "y"), (113, "日本語 ☃ " * 30), (114, " ".join(prose(3000)) + " " + " ".join(passage)),
             (115, "a b c d e"), (116, "a b c d e"), (117, "line\n" * 40)]
    return rows


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) rows, with columns whose names operators use themselves."""
    def make(rows, partitions=3):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        from pyspark.sql import functions as F

        return df.repartition(partitions).withColumns({c: F.lit("clash") for c in ("digest", "key", "n", "node", "component", "block", "kept", "row", "bucket")})
    return make
