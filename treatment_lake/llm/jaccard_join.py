"""N-gram Jaccard join: size-aware, heavy and light (operator 7).

A document is the set of its distinct word shingles (``words`` words, A-Z
lower-cased; fewer words: the whole sequence is the one shingle). Two
documents link when their sets' Jaccard similarity reaches ``percent``.

1. Equal sets fold into the smallest id; of the other sets, each keeps the
   shingles that some different set has, with their frequencies.
2. In the order (frequency, hash) linked sets share one of their first
   ``n - ceil(t n) + 1`` shingles. Sets whose prefix is shared with nobody are done.
3. Small sets (up to a size chosen by cost) enumerate, for each partner size,
   the subsets of the overlap that a link needs; sets that meet in a subset
   are linked, and a star per subset says so without pairs.
4. Large sets scan inverted lists. The prefix lists' connected components hold
   all their links; a component's sets meet in a unit of bounded size, where
   a set counts its overlaps along the lists of the sets that are not linked
   to it yet and stops as soon as all are. A component beyond the bound is
   dealt to salted units, linked there, dealt anew, and what has not joined its
   largest group is finally scanned against all of it in blocks.

So no link between different sets is lost, and a dense group of copies costs
a few scans instead of its pairs. Shingles are 64-bit hashes: a wrong
equality in a pair has a chance of ``|A| * |B| / 2**64``.

Defined results
- null or empty text, text without words: empty set, linked with nothing;
- null identifiers: not compared, one row each with their own null class;
- repeated rows: one row each, same class; rows that share an identifier are one node;
- very long texts: whole; empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .components import components
from .marks import Extract, gram_hashes, merged_marks, shared_marks
from .registry import query, stored, table
from .repeats import Words

LARGEST_SMALL = 16  # no set beyond this size enumerates subsets, whatever the costs say
UNIT_MARKS = 300_000  # shingles of a unit of sets that are linked in one place
ROUNDS = 2  # salted rounds before the final scan of an oversized component


def extractor(k: int) -> Extract:
    """Each text's distinct shingles, sorted; words are found and hashed for many texts at once."""
    kind = Words(k, k)

    def extract(texts: list[str]) -> list[tuple[bytes, np.ndarray]]:
        plains = [kind.plain(t.encode("utf-8", "surrogatepass").lower()) for t in texts]
        x = kind.numbers(kind.tokens(kind.between.join(p for p in plains if p)))
        grams, at, out = gram_hashes(x, k), 0, []
        for n in map(kind.count, plains):
            if n >= k:
                own = np.unique(grams[at:at + n - k + 1])
            else:  # the whole sequence, told from others by its length too; none without words
                own = gram_hashes(np.r_[np.uint64(n), x[at:at + n]], n + 1) if n else x[:0]
            at += n
            out.append((xxhash.xxh3_128_digest(own.tobytes()), own))
        return out

    return extract


def needed(a: int, b: int, percent: int) -> int:
    """Least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _survive(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Sets with a shared prefix: ``doc_id, n, marks`` (shared, sorted), ``prefix``, ``scan`` (its list entries)."""
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "n": [], "marks": [], "prefix": [], "scan": []}
        for doc_id, n, parts, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
            mark = np.frombuffer(b"".join(parts), np.uint64)
            count = np.frombuffer(b"".join(counts), np.uint32)
            left = prefix_length(n, percent) - (n - len(mark))
            if left > 0:
                first = np.lexsort((mark, count))[:left]
                out["doc_id"].append(doc_id), out["n"].append(n), out["marks"].append(np.sort(mark).tobytes())
                out["prefix"].append(mark[first].view(np.int64)), out["scan"].append(int(count[first].sum()))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("doc_id", pa.int64()), ("n", pa.int64()), ("marks", pa.binary()), ("prefix", pa.list_(pa.int64())), ("scan", pa.int64())]))


# ---- small sets

def subset_keys(n: int, percent: int, shared: int | None = None, largest: int | None = None) -> Iterator[tuple[int, int, int]]:
    """(smaller size, larger size, overlap) of the links that a set of size ``n`` can have."""
    for b in range(-(-percent * n // 100), min(100 * n // percent, largest or n * 100) + 1):
        c = needed(n, b, percent)
        if c <= min(n, b, n if shared is None else shared):
            yield min(n, b), max(n, b), c


def boundary(per_size: dict[int, tuple[int, int]], percent: int) -> int:
    """The largest small size: subsets of the sets up to it plus list entries of the sets beyond it are fewest.

    ``per_size``: size -> (number of sets, entries on their prefix lists)."""
    best, at, scan, enumerate_ = None, 0, sum(s for _, s in per_size.values()), 0
    for x in range(LARGEST_SMALL + 1):
        sets, entries = per_size.get(x, (0, 0))
        enumerate_ += sets * sum(math.comb(x, c) for _, _, c in subset_keys(x, percent)) if x else 0
        scan -= entries
        if best is None or enumerate_ + scan < best:
            best, at = enumerate_ + scan, x
    return at


def _subsets(batches: Iterator[pa.RecordBatch], percent: int, x: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("smaller", pa.bool_())])
    for batch in batches:
        keys, docs, smaller = [], [], []
        for doc_id, n, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
            marks = [raw[i:i + 8] for i in range(0, len(raw), 8)]
            for a, b, c in subset_keys(n, percent, len(marks), x):
                for subset in itertools.combinations(marks, c):
                    keys.append(xxhash.xxh3_128_digest(bytes((a, b)) + b"".join(subset)))
                    docs.append(doc_id), smaller.append(n == a)
            if len(keys) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(smaller)], schema=schema)
                keys, docs, smaller = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(smaller, pa.bool_())], schema=schema)


def small_links(sets: DataFrame, percent: int, x: int) -> DataFrame:
    """Edges ``a, b``: in each subset the smallest id of the smaller size links to all others (each is a link)."""
    met = sets.where(F.col("n") <= x).select("doc_id", "n", "marks").mapInArrow(
        lambda it: _subsets(it, percent, x), "key binary, doc_id long, smaller boolean")
    centre = (met.groupBy("key").agg(F.min(F.when(F.col("smaller"), F.col("doc_id"))).alias("a"), F.min("doc_id").alias("lo"),
                                     F.max("doc_id").alias("hi")).where("a IS NOT NULL AND lo < hi").select("key", "a"))
    return met.join(centre, "key").where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()


# ---- large sets

class Lists:
    """Inverted lists of a unit's sets, rebuilt when most of the sets are settled."""

    def __init__(self, marks: list[np.ndarray]):
        self.m = len(marks)
        owner = np.repeat(np.arange(self.m), [len(x) for x in marks])
        all_marks = np.concatenate(marks) if self.m else np.empty(0, np.uint64)
        _, token, count = np.unique(all_marks, return_inverse=True, return_counts=True)
        shared = count[token] > 1
        self.owner, self.token, self.tokens = owner[shared], token[shared], len(count)
        self.starts = np.searchsorted(self.owner, np.arange(self.m + 1))
        self.only(np.ones(self.m, bool))

    def only(self, sets: np.ndarray) -> None:
        inside = sets[self.owner]
        token, owner = self.token[inside], self.owner[inside]
        by = np.argsort(token, kind="stable")
        self.members = owner[by]
        self.at = np.searchsorted(token[by], np.arange(self.tokens + 1))
        self.indexed = int(sets.sum())

    def overlaps(self, one: int) -> np.ndarray:
        """Overlap of set ``one`` with every indexed set, along the lists of its tokens."""
        tokens = self.token[self.starts[one]:self.starts[one + 1]]
        first, size = self.at[tokens], self.at[tokens + 1] - self.at[tokens]
        total = int(size.sum())
        if not total:
            return np.zeros(self.m, dtype=np.int64)
        ends = np.cumsum(size)
        where = np.arange(total) + np.repeat(first - (ends - size), size)
        return np.bincount(self.members[where], minlength=self.m)


def link_group(ids: np.ndarray, sizes: np.ndarray, marks: list[np.ndarray], groups: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that connect all linked sets, given that equal ``groups`` are connected already."""
    lists = Lists(marks)
    _, group = np.unique(groups, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[by_group], np.arange(group.max(initial=-1) + 2))
    waiting, edges = np.ones(len(ids), bool), []
    for seed in range(len(ids)):
        if not waiting[seed]:
            continue
        queue = list(by_group[bounds[group[seed]]:bounds[group[seed] + 1]])
        waiting[queue] = False
        while queue:
            left = int(waiting.sum())
            if not left:
                return edges
            if left * 2 < lists.indexed:
                lists.only(waiting)
            one = queue.pop()
            common = lists.overlaps(one)
            hits = np.flatnonzero(waiting & (common > 0) & (100 * common >= percent * (sizes[one] + sizes - common)))
            for g in np.unique(group[hits]):
                own = by_group[bounds[g]:bounds[g + 1]]
                edges.append((int(ids[one]), int(hits[group[hits] == g][0])))
                queue += list(own)
                waiting[own] = False
    return edges


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    return (rows["doc_id"].to_numpy(), rows["n"].to_numpy(), [np.frombuffer(x, np.uint64) for x in rows["marks"].to_pylist()],
            rows["comp"].to_numpy(), rows["grp"].to_numpy())


def _edges(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _link_unit(rows: pa.Table, percent: int) -> pa.Table:
    """All components of a unit, each for itself."""
    ids, sizes, marks, comp, groups = _columns(rows)
    by = np.lexsort((ids, comp))
    cuts = np.flatnonzero(np.r_[True, comp[by][1:] != comp[by][:-1], True]) if len(by) else []
    found: list[tuple[int, int]] = []
    for a, z in zip(cuts[:-1], cuts[1:]):
        own = by[a:z]
        found += [(x, int(ids[own][y])) for x, y in link_group(ids[own], sizes[own], [marks[i] for i in own], groups[own], percent)]
    return _edges(found)


def _scan_unit(rows: pa.Table, percent: int) -> pa.Table:
    """The rows that ask against those that do not ask only."""
    ids, sizes, marks, _, groups = _columns(rows)
    asks, member = rows["asks"].to_numpy(zero_copy_only=False), rows["member"].to_numpy(zero_copy_only=False)
    lists, found = Lists(marks), []
    lists.only(member)
    for one in np.flatnonzero(asks):
        common = lists.overlaps(one)
        hits = np.flatnonzero(member & (groups != groups[one]) & (common > 0) & (100 * common >= percent * (sizes[one] + sizes - common)))
        _, first = np.unique(groups[hits], return_index=True)
        found += [(int(ids[one]), int(ids[h])) for h in hits[first]]
    return _edges(found)


def large_links(spark: SparkSession, sets: DataFrame, percent: int, x: int, buckets: int, unit_marks: int) -> DataFrame:
    """Edges ``a, b`` that connect all sets linked through a set larger than ``x``."""
    part = stored(spark, sets.where(F.col("n") * 100 >= percent * (x + 1)), scratch_path(spark, "jaccard-large"))
    entries = part.select("doc_id", "n", F.explode("prefix").alias("mark"))
    centre = (entries.groupBy("mark").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("hi"), F.max("n").alias("longest"))
              .where((F.col("a") < F.col("hi")) & (F.col("longest") > x)).select("mark", "a"))
    near = entries.join(centre, "mark").where("a <> doc_id").select(F.col("doc_id").alias("a"), F.col("a").alias("b")).distinct()
    comps = components(spark, near)
    weighed = part.join(comps, F.col("doc_id") == F.col("node")).select(
        "doc_id", "n", "marks", F.col("component").alias("comp"), (F.octet_length("marks") / 8).cast("long").alias("w"))
    load = weighed.groupBy("comp").agg(F.sum("w").alias("load")).withColumn("units", F.ceil(F.col("load") / unit_marks).cast("int"))
    rows = stored(spark, weighed.join(load.select("comp", "units"), "comp"), scratch_path(spark, "jaccard-rows"))

    def link(of: DataFrame, turn: int) -> DataFrame:
        salt = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.col("units"))
        unit = F.when(F.col("units") > 1, F.xxhash64("comp", salt)).otherwise(F.pmod(F.xxhash64("comp"), F.lit(buckets)))
        return stored(spark, of.withColumn("unit", unit).groupBy("unit").applyInArrow(
            lambda t: _link_unit(t, percent), "a long, b long"), scratch_path(spark, "jaccard-edges"))

    def grouped(edges: DataFrame) -> DataFrame:
        """Rows of oversized components with the group that the edges so far put them in."""
        of = components(spark, edges)
        return big.drop("grp").join(of, F.col("doc_id") == F.col("node"), "left").withColumn(
            "grp", F.coalesce("component", "doc_id")).drop("node", "component")

    big = rows.where("units > 1")
    edges = link(rows.withColumn("grp", F.col("doc_id")), 0)
    if not big.head(1):
        return edges
    for turn in range(1, ROUNDS):
        edges = edges.unionByName(link(grouped(edges), turn))
    last = stored(spark, grouped(edges), scratch_path(spark, "jaccard-groups"))
    by_group = last.groupBy("comp", "grp").agg(F.sum("w").alias("w"))
    main = by_group.groupBy("comp").agg(F.max(F.struct("w", "grp")).alias("m")).select("comp", F.col("m.grp").alias("main"))
    asking = last.join(main, "comp").where("grp <> main").drop("main")
    blocks = asking.groupBy("comp").agg(F.ceil(F.sum("w") / unit_marks).cast("int").alias("ask_units"))
    asking = asking.join(blocks, "comp")
    ask = (asking.withColumn("p", F.pmod(F.xxhash64("doc_id", F.lit(101)), F.col("ask_units")).cast("int"))
           .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("units") - 1))).withColumn("asks", F.lit(True)).withColumn("member", F.lit(False)))
    tell = (last.join(blocks, "comp").withColumn("q", F.pmod(F.xxhash64("doc_id", F.lit(103)), F.col("units")).cast("int"))
            .withColumn("p", F.explode(F.sequence(F.lit(0), F.col("ask_units") - 1))).withColumn("asks", F.lit(False)).withColumn("member", F.lit(True)))
    columns = ["doc_id", "n", "marks", "comp", "grp", "p", "q", "asks", "member"]
    swept = ask.select(columns).unionByName(tell.select(columns)).withColumn("unit", F.xxhash64("comp", "p", "q"))
    return edges.unionByName(stored(spark, swept.groupBy("unit").applyInArrow(
        lambda t: _scan_unit(t, percent), "a long, b long"), scratch_path(spark, "jaccard-sweep")))


def jaccard_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                       percent: int = 75, buckets: int | None = None, unit_marks: int = UNIT_MARKS, small_up_to: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links).

    ``small_up_to``: the boundary between small and large sets (default: by cost).
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(spark, shared_marks(named, lambda: extractor(words), buckets), scratch_path(spark, "jaccard-marks"))
    info = found.where("size IS NOT NULL").select("doc_id", "text_key", F.col("size").alias("n"))
    sizes = info.distinct()
    sets = stored(spark, merged_marks(found).join(sizes, ["doc_id", "text_key"]).select("doc_id", "n", "marks", "counts")
                  .mapInArrow(lambda it: _survive(it, percent), "doc_id long, n long, marks binary, prefix array<long>, scan long"),
                  scratch_path(spark, "jaccard-sets"))
    if small_up_to is None:
        per_size = sets.where(F.col("n") <= LARGEST_SMALL).groupBy("n").agg(F.count(F.lit(1)).alias("c"), F.sum("scan").alias("s")).collect()
        small_up_to = boundary({r["n"]: (r["c"], r["s"]) for r in per_size}, percent)
    edges = large_links(spark, sets, percent, small_up_to, buckets, unit_marks)
    if small_up_to:
        edges = edges.unionByName(small_links(sets, percent, small_up_to))
    same = info.where("n > 0").groupBy("text_key").agg(F.min("doc_id").alias("first"))
    classes = components(spark, edges)
    # stored, so that the join below reads a plain shuffle on both sides and a hot key can be split
    first_of = stored(spark, same.join(classes, F.col("first") == F.col("node"), "left").select(
        F.col("text_key").alias("_key"), F.coalesce("component", "first").alias("component_id")), scratch_path(spark, "jaccard-classes"))
    out = (info.join(first_of, F.col("text_key") == F.col("_key"), "left")
           .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
    nameless = docs.where(F.col(id_col).isNull()).select(F.col(text_col).alias("text"))
    alone = nameless.mapInPandas(lambda it: _nameless(it, words), "doc_id long, n_shingles long, component_id long")
    return out.unionByName(alone)


def _nameless(frames: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    extract = extractor(words)
    for f in frames:
        n = [len(x) for _, x in extract([t or "" for t in f["text"]])]
        none = pd.Series([None] * len(n), dtype="Int64")
        yield pd.DataFrame({"doc_id": none, "n_shingles": n, "component_id": none})


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))
