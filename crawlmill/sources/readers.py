"""Inputs: fetched pages, files, site texts, seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.schemas import FETCHED_PAGE, TABLES

SEEDS = T.StructType([
    T.StructField("seed_order", T.LongType()),
    T.StructField("url", T.StringType()),
])


def read_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = FETCHED_PAGE
) -> DataFrame:
    """Fetched pages from any columnar or text table format Spark reads."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_page_files(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """One row per HTML file below ``path``: ``file_path, html``."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("html"))
    )


def read_binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file below ``path``: ``path, modificationTime, length, content``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )


def read_site_texts(spark: SparkSession, path: str, pattern: str, column: str) -> DataFrame:
    """Robots files or sitemaps stored as ``<path>/<domain>/<file>``: ``domain`` and text."""
    files = read_page_files(spark, path, pattern)
    return files.select(
        F.element_at(F.split("file_path", "/"), -2).alias("domain"), F.col("html").alias(column)
    )


def read_table(spark: SparkSession, name: str, *paths: str) -> DataFrame:
    """A crawl table by name from its parquet paths, with the fixed schema."""
    return spark.read.schema(TABLES[name]).parquet(*paths)


def seed_urls(spark: SparkSession, urls: Sequence[str]) -> DataFrame:
    """The configured seed URLs in their order; they are expected to be canonical."""
    return spark.createDataFrame(list(enumerate(urls)), SEEDS)


def page_stream(
    spark: SparkSession, path: str, pattern: str = "*.parquet",
    schema: T.StructType = FETCHED_PAGE, max_files: int | None = None,
) -> DataFrame:
    """Pages (or rows of another ``schema``) as they arrive as parquet files in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
