"""Corpus pipeline: documents in, a mixed and cleaned corpus with the words to take of each document out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet in the shared folder and read again as the
next stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm import decontaminate, jaccard_join, lang_id, mixing, secrets
from deltaloom.llm.registry import table
from deltaloom.storage import cut_lineage

#: Least share of a text's n-grams that its language must know.
LEAST_SCORE = 0.2

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters, or with enough n-grams that no language knows, go."""
    found = lang_id.identify(docs, lang_id.train(docs))
    kept = (F.col("_language.score") >= LEAST_SCORE) | (F.col("_language.n_grams") < lang_id.FEW)
    return found.where((F.col("_language.lang_pred") != lang_id.UNKNOWN) & kept).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    scanned = decontaminate.scan(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return decontaminate.remove_documents(scanned).select(*COLUMNS)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    clean = docs.select(*COLUMNS, secrets.redacted(F.col("text")).alias("clean"))
    n_chars = F.when(F.col("clean") == F.col("text"), F.col("n_chars")).otherwise(F.length("clean").cast("long"))
    return clean.select("doc_id", F.col("clean").alias("text"), "lang", "source", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars).alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take of every remaining document."""
    return mixing.mix(docs, mixing.label_weights(table(spark, sf_dir, "labels"))).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("secret scans", secret_spans),
    ("mixing sources", mix),
]

#: Language identification and similarity joins are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
