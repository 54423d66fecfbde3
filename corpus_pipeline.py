"""The corpus pipeline: documents -> language ID -> exact dedup -> near dedup -> substring dedup -> packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. All stages but the last return the columns of
``documents``; each is written as Parquet to the shared folder and read
again, so a lost executor costs a re-read and not the stages before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treatment_lake.llm.exact_dedup import exact_dedup, keep_rows
from treatment_lake.llm.jaccard_join import jaccard_components
from treatment_lake.llm.langid import learn, predict, taught, with_letters
from treatment_lake.llm.packing import pack
from treatment_lake.llm.registry import stored
from treatment_lake.llm.suffix_trees import substring_dedup
from treatment_lake.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters, no text) go; a short or unusual text with one stays.

    Where nothing can be learned, the letters alone decide."""
    model = learn(taught(docs))
    if not model["langs"]:
        return with_letters(docs)
    judged = predict(docs, model, carry=docs.columns)
    return judged.where(F.col("lang_pred") != "und").select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id stays."""
    return keep_rows(docs, exact_dedup(spark, docs)).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five-word shingles, Jaccard 0.75) the smallest id stays."""
    goes = jaccard_components(spark, docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_goes")).distinct()
    return docs.join(goes, F.col("doc_id") == F.col("_goes"), "left_anti")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word passages that a smaller id has go; a text that loses none stays as it is."""
    cut = substring_dedup(spark, docs, carry=docs.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns({"n_chars": n_chars, "text": text}).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, placed in sequences."""
    return pack(spark, docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", substrings), ("packing", packing)]

#: The model-based stages (1 and 5) are not SQL; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
