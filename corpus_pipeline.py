"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the
last return the columns of the documents; extra columns pass through. ``doc_id`` names a document:
rows that share it stay or go together.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmill.llm.catalog import WORDS_FILE
from crawlmill.llm.exact_dedup import deduplicate
from crawlmill.llm.packing import pack, text_cluster, word_count
from crawlmill.llm.quality import score_quality
from crawlmill.llm.secrets import redact
from crawlmill.llm.simhash import simhash_components
from crawlmill.session import materialize, new_work_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; it learns from the labels beside them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    scored = score_quality(rows, labels)
    # Dropped by a generator: a filter would be pushed below the statistics and repeat them.
    kept = F.explode(F.when(F.col("predicted") == 1, F.array(F.lit(1)))).alias("kept")
    return scored.select("row", kept).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, with the largest id."""
    return deduplicate(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints, with the smallest id."""
    found = simhash_components(docs)
    # The ids that go are the smaller side: documents are joined with these alone.
    first = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    goes = found.groupBy(F.col("doc_id").alias("goes")).agg(first.alias("first")).filter("not first")
    goes = materialize(goes.select("goes"), "goes")
    return docs.join(goes, docs["doc_id"].eqNullSafe(goes["goes"]), "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; n_chars follows the text."""
    clean = redact(docs, public_tokenizers.path(WORDS_FILE))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return clean


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, cut into pieces and packed into sequences."""
    return pack(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("n_words"), text_cluster(F.col("text")).alias("cluster"))
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the trained classifier nor the packing; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
