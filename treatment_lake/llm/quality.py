"""Quality by hierarchical empirical Bayes (operator 2).

Three kinds of evidence about a document meet as log odds:

1. a logistic regression on a dozen shape features of its text, fitted on
   labelled documents;
2. the posterior of its host (the source) and
3. the posterior of its path (the source's section in one language).

A site's rate is the mean of its documents' labels, or of the classifier's
probability where there is no label. Posteriors shrink towards the level
above: a host towards the global rate, a path towards its host, by a
prior weight that the method of moments estimates from how much the rates of
a level differ beyond what their sizes explain. All of it is grouped
aggregation: a source with a third of all rows is summed on the map side,
and the site table joins back as one row per site.

Only the classifier is fitted on a bounded sample (``max_train_rows``
labelled rows, by a hash of the identifier); rates use all documents.

Defined results
- null or empty text: features of an empty text; null source or language: a
  site of its own;
- null labels are no labels; several labels of one document: their mean,
  rounded up from a half; labels of one kind only, or none: no classifier
  evidence, its probability is the global rate (one half without labels);
- null identifiers and repeated rows: one result each;
- empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .registry import query, stored, table

LEAST, MOST = 1e-4, 1 - 1e-4


def features(text: Column) -> list[tuple[str, Column]]:
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.char_length(t), F.lit(1))
    words, lines = F.split(F.trim(t), r"\s+"), F.split(t, "\n")

    def share_without(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(t, pattern, "")) / n

    def share_of(char: str) -> Column:
        return (F.char_length(t) - F.char_length(F.replace(t, F.lit(char), F.lit("")))) / n

    return [("log_n", F.log(n + F.lit(1.0))), ("lower", share_without(r"\p{Lu}+")), ("symbols", share_without(r"[\p{L}\p{N}\s]+")),
            ("digits", share_without(r"[^0-9]+")), ("word_len", F.log(n / F.size(words))),
            ("fresh_words", F.size(F.array_distinct(words)) / F.size(words)),
            ("fresh_words_n", F.size(F.array_distinct(words)) / F.size(words) * F.log(n + F.lit(1.0))),
            ("fresh_lines", F.size(F.array_distinct(lines)) / F.size(lines)), ("lines", F.size(lines) / F.size(words)),
            ("bars", share_of("|")), ("bangs", share_of("!")), ("stops", share_of("."))]


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(MOST)), F.lit(LEAST))
    return F.log(p / (1 - p))


def _classifier(rows: DataFrame, names: list[str], max_train_rows: int, rate: float) -> DataFrame:
    """``rows`` with ``p_doc``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    labelled = rows.where("y IS NOT NULL")
    kinds = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    if len(kinds) < 2:
        return rows.withColumn("p_doc", F.lit(rate))
    total, scale = sum(kinds.values()), 1_000_000
    cut = min(scale, max(1, scale * max_train_rows // total))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < cut)
    if len(sample.select("y").distinct().take(2)) < 2:
        sample = labelled
    build = VectorAssembler(inputCols=names, outputCol="_x", handleInvalid="keep")
    fit = LogisticRegression(featuresCol="_x", labelCol="y", probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c",
                             maxIter=50, regParam=1e-4).fit(build.transform(sample.select("y", *names)))
    return fit.transform(build.transform(rows)).withColumn("p_doc", vector_to_array("_p")[1]).drop("_x", "_p", "_r", "_c")


def _prior_weight(sites: DataFrame, centre: Column) -> float:
    """Pseudo-documents of a level's prior: m(1-m) / (variance between sites) - 1, within 1 and 1e6."""
    p, n = F.col("s") / F.col("n"), F.col("n")
    r = sites.agg(F.sum(n * (p - centre) ** 2).alias("d"), F.sum(centre * (1 - centre)).alias("noise"),
                  F.sum(n).alias("n"), F.sum(n * centre * (1 - centre)).alias("m")).first()
    if not r["n"]:
        return 1.0
    between = (r["d"] - r["noise"]) / r["n"]
    return 1e6 if between <= 0 else float(min(1e6, max(1.0, (r["m"] / r["n"]) / between - 1)))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang", label_col: str = "quality", max_train_rows: int = 50_000,
          keep_from: float = 0.5) -> DataFrame:
    """``doc_id, host, path, p_doc, p_host, p_path, quality, kept`` (quality: probability of a good document)."""
    shape = features(F.col(text_col))
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_of"))
             .agg(F.floor(F.avg(F.col(label_col).cast("double")) + 0.5).cast("double").alias("y")))
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                        F.col(path_col).cast("string").alias("path"), *[c.cast("double").alias(k) for k, c in shape])
    rows = stored(spark, plain.join(marks, F.col("doc_id") == F.col("_of"), "left").drop("_of"), scratch_path(spark, "quality-features"))
    known = rows.agg(F.avg("y")).first()[0]
    rows = _classifier(rows, [k for k, _ in shape], max_train_rows, 0.5 if known is None else float(known))
    rows = stored(spark, rows.select("doc_id", "host", "path", "y", "p_doc"), scratch_path(spark, "quality-evidence"))

    value = F.coalesce("y", "p_doc")
    paths = rows.groupBy("host", "path").agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    r = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = min(MOST, max(LEAST, r["s"] / r["n"])) if r["n"] else 0.5
    k_host = _prior_weight(hosts, F.lit(mean))
    hosts = hosts.select("host", ((F.col("s") + k_host * mean) / (F.col("n") + k_host)).alias("p_host"))
    h = hosts.select(F.col("host").alias("_h"), "p_host")
    nested = paths.join(h, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    k_path = _prior_weight(nested, F.col("p_host"))
    sites = stored(spark, nested.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "p_host",
                                        ((F.col("s") + k_path * F.col("p_host")) / (F.col("n") + k_path)).alias("p_path")),
                   scratch_path(spark, "quality-sites"))
    odds = _logit(F.col("p_doc")) + _logit(F.col("p_path")) - _logit(F.lit(mean))
    out = rows.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    return (out.withColumn("quality", 1 / (1 + F.exp(-odds)))
            .select("doc_id", "host", "path", "p_doc", "p_host", "p_path", "quality", (F.col("quality") >= keep_from).alias("kept")))


@query("op2_quality_bayes")
def op2_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
