"""Language identification with hyperdimensional profiles (operator 3).

Every letter has a random vector of +1/-1 (drawn from its code point alone).
A trigram is bound from its letters' vectors, permuted by position:
``roll(a, 2) * roll(b, 1) * c``. A document's profile bundles (adds) the
vectors of its trigrams, a language's prototype bundles those of its
documents, and the language whose prototype has the largest cosine wins.
Words are runs of letters, lower-cased, with one blank between them; the
blank is a letter of its own.

Learning is one pass (a partial bundle per task, added up by dimension) and
prediction another; the model is languages x dimensions numbers, whatever
the size of the corpus. Documents stay where they are read: nothing about
a single document moves, so hot sources and copies cost nothing extra.

Defined results
- null, empty or letterless text: language ``und``, score 0;
- null lang: not learned from; null identifier: neither learned from nor held out;
- a tie between prototypes: the language that sorts first;
- nothing to learn from: every language is ``und`` with score 0;
- very long texts: whole, in slices; repeated rows: one prediction each;
- empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .marks import slices
from .registry import bounded_batches, query, table

MAX_LANGUAGES = 2000  # a label set larger than this is an error, not a language column


class Space:
    """Letter and trigram vectors of one hyperspace."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed, self.letters = dims, seed, {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(0, 2, self.dims, dtype=np.int8)
            self.letters[code] = (2 * bits - 1).astype(np.int8)
        return self.letters[code]

    def trigrams(self, codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
        """One vector for each code ``(a * K + b) * K + c`` over the alphabet of K code points."""
        k = len(alphabet)
        base = np.stack([self.letter(int(x)) for x in alphabet])
        a, b, c = codes // (k * k), codes // k % k, codes % k
        out = np.roll(base, 2, axis=1)[a]
        out *= np.roll(base, 1, axis=1)[b]
        out *= base[c]
        return out


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram codes, the text each belongs to, alphabet). The alphabet's entry 0 is the blank."""
    low = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) for t in low])
    present = np.flatnonzero(np.bincount(points))
    letters = np.array([x for x in present.tolist() if chr(x).isalpha()], dtype=np.int64)
    alphabet = np.concatenate([[32], letters]).astype(np.int64)
    index = np.zeros(int(present[-1]) + 1, dtype=np.int64)
    index[letters] = np.arange(1, len(alphabet))
    x = index[points]
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 0) | (x[:-1] != 0) | (owner[1:] != owner[:-1])
    x, owner = x[keep], owner[keep]
    k = len(alphabet)
    codes = (x[:-2] * k + x[1:-1]) * k + x[2:]
    inside = (owner[2:] == owner[:-2]) & (codes != 0)
    return codes[inside], owner[:-2][inside], alphabet


def counted(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if k ** 3 <= 4_000_000:
        counts = np.bincount(codes)
        found = np.flatnonzero(counts)
        return found, counts[found]
    return np.unique(codes, return_counts=True)


def _learn(batches: Iterator[pa.RecordBatch], dims: int, seed: int) -> Iterator[pa.RecordBatch]:
    space, bundles = Space(dims, seed), {}
    for batch in batches:
        lang = np.array(batch.column(1).to_pylist(), dtype=object)
        for one in sorted(set(lang)):
            rows = np.flatnonzero(lang == one)
            texts = ((int(r), batch.column(0)[int(r)].as_py()) for r in rows)
            for _, part in slices((r, t) for r, t in texts if t):
                codes, _, alphabet = trigram_codes(part)
                if len(codes):
                    found, n = counted(codes, len(alphabet))
                    total = np.zeros(dims)
                    for at in range(0, len(found), 8192):
                        total += n[at:at + 8192].astype(np.float64) @ space.trigrams(found[at:at + 8192], alphabet)
                    bundles[one] = bundles.get(one, 0) + np.rint(total).astype(np.int64)
    for one, vector in sorted(bundles.items()):
        yield pa.RecordBatch.from_arrays([pa.array([one] * dims), pa.array(np.arange(dims, dtype=np.int32)), pa.array(vector)],
                                         names=["lang", "dim", "value"])


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = 1024, seed: int = 7) -> dict:
    """Prototypes of the languages of ``train``: ``{"langs", "vectors", "dims", "seed"}`` (languages x dims numbers)."""
    bounded_batches(train.sparkSession)
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = (rows.mapInArrow(lambda it: _learn(it, dims, seed), "lang string, dim int, value long")
            .groupBy("lang", "dim").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
            .select("lang", F.col("v.value").alias("v")).limit(MAX_LANGUAGES + 1).collect())
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the label column")
    sums = sorted(sums, key=lambda r: r["lang"])
    vectors = np.array([r["v"] for r in sums], dtype=np.float64).reshape(len(sums), dims)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return {"langs": [r["lang"] for r in sums], "vectors": vectors / np.where(norms > 0, norms, 1), "dims": dims, "seed": seed}


def cosines(texts: list[str], model: dict, space: Space) -> np.ndarray:
    """Texts x languages; a row of NaN where a text has no letters."""
    codes, owner, alphabet = trigram_codes(texts)
    out = np.full((len(texts), len(model["langs"])), np.nan)
    if not len(codes):
        return out
    found, _ = counted(codes, len(alphabet))
    vectors = space.trigrams(found, alphabet)
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    where = None
    if len(alphabet) ** 3 <= 4_000_000:
        where = np.zeros(int(found[-1]) + 1, dtype=np.int32)
        where[found] = np.arange(len(found))
    for i in range(len(texts)):
        own = codes[starts[i]:starts[i + 1]]
        if len(own):
            own = where[own] if where is not None else np.searchsorted(found, own)
            ids, n = np.unique(own, return_counts=True)
            profile = np.zeros(model["dims"], dtype=np.float32)
            for at in range(0, len(ids), 4096):
                profile += n[at:at + 4096].astype(np.float32) @ vectors[ids[at:at + 4096]].astype(np.float32)
            profile = profile.astype(np.float64)
            norm = np.linalg.norm(profile)
            out[i] = model["vectors"] @ profile / norm if norm else 0.0
    return out


def _predict(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    """The last column is the text; the others pass through, then come the language and its score."""
    space = Space(model["dims"], model["seed"])
    for batch in batches:
        langs, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
        texts = ((r, x.as_py()) for r, x in enumerate(batch.column(batch.num_columns - 1)))
        for rows, part in slices((r, t) for r, t in texts if t and model["langs"]):
            cos = cosines(part, model, space)
            lettered = ~np.isnan(cos).any(axis=1)
            best = np.argmax(np.where(np.isnan(cos), -2, cos), axis=1)
            for j, row in enumerate(rows):
                if lettered[j]:
                    langs[row], scores[row] = model["langs"][best[j]], min(1.0, max(0.0, cos[j, best[j]]))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs), pa.array(scores)],
                                         names=[*batch.schema.names[:-1], "lang_pred", "score"])


def held_out(id_col: str, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def taught(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(id_col) & F.col(id_col).isNotNull())


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score`` (the cosine, not below 0).

    ``carry``: columns to pass through instead of the first two."""
    bounded_batches(docs.sparkSession)
    if carry is None:
        rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
        names = ["doc_id", "held_out"]
    else:
        rows, names = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(text_col).alias("text")), carry
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    out = rows.mapInArrow(lambda it: _predict(it, model), f"{kinds}, lang_pred string, score double")
    return out.toDF(*names, "lang_pred", "score")


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents whose text has a letter; needs no model."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t.as_py() or "")) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(some, docs.schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dims: int = 1024) -> DataFrame:
    """Learns from the labelled documents that are not held out, predicts for all."""
    return predict(docs, learn(taught(docs, id_col), text_col, lang_col, dims), id_col, text_col)


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
