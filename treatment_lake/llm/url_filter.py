"""URL filter: rules, then naive Bayes over Viterbi-segmented host and path (operator 9).

Rules are column expressions; the longest fitting one decides. Every other
url is judged by the method:

1. word counts of the pages' visible texts and paths give a unigram model;
2. each distinct host is cut at its dots, hyphens and digits, and unigram
   Viterbi splits the concatenated names that remain into words;
3. multinomial naive Bayes, learned from the urls that a rule decides, adds
   the log odds of the host's words and of the path's tokens.

The model is never broadcast: a host's substrings are joined with the
counts, and token lists are reduced to distinct hosts and distinct path
patterns before they meet the weights, so a host that holds a third of all
pages is segmented and scored once. Results join back on host and pattern,
one row per key on that side.

Defined results
- null url or none with ``://``: empty host and path, no rule, judged by the
  prior alone; ties (and no rule-decided urls at all): allow;
- null page_id and repeated rows: one result each; null html: no words;
- very long names: split whole, into words of any length;
- empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .exact_dedup import UPPER
from .registry import query, stored, table

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def ascii_lowered(x: Column) -> Column:
    return F.translate(x, UPPER, UPPER.lower())


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = ascii_lowered(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, r_host, r_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        rule = F.when(fits, F.lit(r_host + r_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def letter_runs(x: Column) -> Column:
    return F.filter(F.split(F.lower(x), r"[^\p{L}]+"), lambda w: w != "")


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n`` over the visible texts (``html``) and the paths of all pages."""
    shown = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    words = F.concat(letter_runs(shown), letter_runs(F.col("path")))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(name: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The likeliest split; an unknown word of k letters counts 10 / (total * 10^k), never more than a known one.

    The best unknown word that ends at a place is the best over all starts of (score there + letters before it), which
    only grows, so unknown words of any length cost one step a letter."""
    n, ten = len(name), math.log(10.0)
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    unknown = math.log(10.0 / total)
    arcs: dict[int, list[int]] = {}
    for start, end in sorted(known):
        arcs.setdefault(end, []).append(start)
    lead, first = -math.inf, 0
    for end in range(1, n + 1):
        if best[end - 1] + (end - 1) * ten > lead:
            lead, first = best[end - 1] + (end - 1) * ten, end - 1
        best[end], back[end] = lead + unknown - end * ten, first
        for start in arcs.get(end, ()):
            score = best[start] + known[start, end]
            if score > best[end]:
                best[end], back[end] = score, start
    out, end = [], n
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _split(frames: Iterator[pd.DataFrame], total: float) -> Iterator[pd.DataFrame]:
    for frame in frames:
        words = []
        for name, found in zip(frame["name"], frame["found"]):
            known = {(int(e["at"]), int(e["at"] + e["len"])): math.log(e["n"] / total) for e in found}
            words.append(viterbi(name, known, total))
        yield pd.DataFrame({"name": frame["name"], "words": words})


def segment_names(names: DataFrame, counts: DataFrame, total: float) -> DataFrame:
    """``name, words`` for every distinct ``name`` (letters only). Substrings are looked up to the length of the longest
    known word that a name could hold."""
    names = names.where(F.length("name") > 0).distinct()
    widest = names.agg(F.max(F.length("name"))).first()[0] or 0
    longest = counts.where(F.length("word") <= widest).agg(F.max(F.length("word"))).first()[0] or 1
    subs = (names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("at"))
            .select("name", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("name") - F.col("at")))).alias("len"))
            .withColumn("word", F.expr("substring(name, at + 1, len)")))
    found = (subs.join(counts, "word").groupBy("name")
             .agg(F.collect_list(F.struct("at", "len", "n")).alias("found")))
    all_names = names.join(found, "name", "left").select(
        "name", F.coalesce("found", F.expr("cast(array() as array<struct<at:int,len:int,n:bigint>>)")).alias("found"))
    return all_names.mapInPandas(lambda it: _split(it, total), "name string, words array<string>")


def path_tokens(path: Column) -> Column:
    """Path parts in lower case, every run of digits as one 0."""
    return F.array_join(F.filter(F.split(F.regexp_replace(ascii_lowered(path), r"\d+", "0"), r"[^\p{L}0]+"), lambda w: w != ""), " ")


def judge(spark: SparkSession, pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", smoothing: float = 1.0) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, host_words``: score is the log odds of block."""
    host, path = split_url(F.col(url_col))
    cut = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"),
                       F.col(html_col).alias("html"))
    counts = stored(spark, word_counts(cut), scratch_path(spark, "url-words"))
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = cut.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("decided"), path_tokens(F.col("path")).alias("pattern"))

    hosts = urls.select("host").distinct()
    parts = hosts.select("host", F.posexplode(letter_runs(F.col("host"))).alias("pos", "name"))
    split = segment_names(parts.select("name"), counts, total)
    host_words = stored(spark, hosts.join(
        parts.join(split, "name").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("w")), "host", "left")
        .select("host", F.coalesce(F.flatten("w.words"), F.expr("cast(array() as array<string>)")).alias("host_words")),
        scratch_path(spark, "url-hosts"))

    # counts by (host | pattern, verdict) first: tokens are spread out over distinct keys, not over pages
    def tokens(side: str, keyed: DataFrame, words: Column) -> DataFrame:
        return keyed.select("key", F.explode(words).alias("token")).select("key", F.concat(F.lit(side), "token").alias("token"))

    host_tokens = tokens("h:", host_words.select(F.col("host").alias("key"), "host_words"), F.col("host_words"))
    patterns = urls.select(F.col("pattern").alias("key")).distinct()
    path_toks = tokens("p:", patterns, F.filter(F.split("key", " "), lambda w: w != ""))
    taught = urls.where("decided IS NOT NULL")
    seen = (host_tokens.join(taught.groupBy(F.col("host").alias("key"), "decided").agg(F.count(F.lit(1)).alias("n")), "key")
            .unionByName(path_toks.join(taught.groupBy(F.col("pattern").alias("key"), "decided").agg(F.count(F.lit(1)).alias("n")), "key")))
    by_token = stored(spark, seen.groupBy("token").agg(F.sum(F.when(F.col("decided") == "block", F.col("n")).otherwise(0)).alias("block"),
                                                       F.sum(F.when(F.col("decided") == "allow", F.col("n")).otherwise(0)).alias("allow")),
                      scratch_path(spark, "url-tokens"))
    size = by_token.agg(F.count(F.lit(1)).alias("v"), F.sum("block").alias("b"), F.sum("allow").alias("a")).first()
    prior = taught.agg(F.count(F.when(F.col("decided") == "block", 1)).alias("b"), F.count(F.when(F.col("decided") == "allow", 1)).alias("a")).first()
    v, b, a = size["v"], float(size["b"] or 0), float(size["a"] or 0)
    start = math.log((prior["b"] + smoothing) / (prior["a"] + smoothing))
    weights = by_token.select("token", (F.log((F.col("block") + smoothing) / (b + smoothing * max(1, v)))
                                        - F.log((F.col("allow") + smoothing) / (a + smoothing * max(1, v)))).alias("w"))

    def scores(toks: DataFrame, key: str, name: str) -> DataFrame:
        return toks.join(weights, "token").groupBy(F.col("key").alias(key)).agg(F.sum("w").alias(name))

    scored = (urls.join(host_words.join(scores(host_tokens, "host", "h"), "host", "left"), "host", "left")
              .join(scores(path_toks, "pattern", "p"), "pattern", "left")
              .withColumn("score", F.lit(start) + F.coalesce("h", F.lit(0.0)) + F.coalesce("p", F.lit(0.0))))
    by_method = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", by_method).alias("verdict"), "score", "host_words")


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, table(spark, sf_dir, "pages"))
