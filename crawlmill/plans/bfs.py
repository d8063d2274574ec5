"""Breadth-first search, one level at a time.

Only links to pages that have links themselves lead further, so the search runs over these alone; all
others are looked at once, when the levels of the pages are known.

Edges and found URLs are tables in the same number of buckets, edges by the page they leave and URLs by
themselves; a bucket of a level is one file. A level meets its edges bucket by bucket, and what it leads to
is shuffled once, to where the URLs found before lie. Edges are shuffled at no level, and found URLs only
where Spark shuffles into more parts than there are buckets. Each level is a partition of the found URLs, which cuts the lineage and lets a lost executor
cost no more than its own tasks. The driver only learns whether a level is empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmill.operators.discovery import first_discovery, unseen_urls
from crawlmill.operators.ranking import numbered
from crawlmill.session import materialize, new_work_path
from crawlmill.sources.writers import write_bucketed

EDGES_OF_BUCKET = 100_000


class _Found:
    """The found URLs: ``url, from_url, seq`` and their order, in buckets by URL, one partition for each level."""

    def __init__(self, spark: SparkSession, name: str, buckets: int) -> None:
        self._spark, self._name, self._buckets = spark, name, buckets
        self._path = new_work_path(spark, "found")

    def add(self, rows: DataFrame, level: int) -> DataFrame:
        """Write a level and give it back. There are no clashes: a level is added once."""
        write_bucketed(rows.withColumn("level", F.lit(level)), self._name, "url", self._buckets, self._path, "level")
        return self.all().where(F.col("level") == level)

    def all(self) -> DataFrame:
        return self._spark.table(self._name)


def next_level(edges: DataFrame, level: DataFrame, found: DataFrame, order: Sequence[str]) -> DataFrame:
    """URLs that a level leads to and that are not found yet, with the page that led there first.

    Edges, level and found URLs come from tables in equal buckets.
    """
    parents = level.select(F.col("url").alias("from_url"), F.col("seq").alias("_parent"))
    met = edges.select("from_url", "url", *order).join(parents, "from_url")
    queue = ["_parent", *order]
    return unseen_urls(first_discovery(met, queue), found).select("url", "from_url", *queue)


def split_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges to URLs that edges leave, and edges to all others."""
    leaving = edges.select(F.col("from_url").alias("url")).distinct()
    return edges.join(leaving, "url", "left_semi"), edges.join(leaving, "url", "left_anti")


def last_level(leaves: DataFrame, found: DataFrame, order: Sequence[str], max_depth: int | None) -> DataFrame:
    """URLs behind the edges that lead no further, one level below the first found page that leads there."""
    parents = found if max_depth is None else found.where(F.col("level") < max_depth)
    parents = parents.select(F.col("url").alias("from_url"), F.col("seq").alias("_parent"), (F.col("level") + 1).alias("level"))
    queue = ["level", "_parent", *order]
    met = leaves.join(parents, "from_url").select("url", "from_url", *queue)
    return unseen_urls(first_discovery(met, queue), found).select("url", "from_url", *queue)


def bfs_levels(
    edges: DataFrame,
    seeds: DataFrame,
    order: Sequence[str] = ("source", "pos"),
    max_depth: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Levels and discovery tree of everything reachable from ``seeds(url, seed_order)``.

    ``edges(from_url, url, order...)`` are links in page order. Result: ``url, level,
    from_url, seq``, where ``seq`` orders a level as a first-in-first-out queue would.
    Seeds have no ``from_url``. ``buckets`` is one for every EDGES_OF_BUCKET edges that lead further unless
    given: a level costs some files and tasks for each, however little it holds. The two tables leave the
    catalog when the search ends; the files stay in the shared folder.
    """
    spark = edges.sparkSession
    name, queue = f"bfs_{uuid.uuid4().hex}", ["_parent", *order]
    narrow = materialize(edges.select("from_url", "url", *order), "links")
    inner, leaves = split_edges(narrow)
    inner = materialize(inner, "inner-links")
    buckets = buckets or inner.count() // EDGES_OF_BUCKET + 1
    write_bucketed(inner, f"{name}_edges", "from_url", buckets, new_work_path(spark, "edges"))
    start = numbered(first_discovery(seeds, ["seed_order"]), ["seed_order"], "seq").select(
        "url", F.lit(None).cast("string").alias("from_url"), F.col("seq").alias("_parent"),
        *[F.lit(None).cast(narrow.schema[c].dataType).alias(c) for c in order], "seq",
    )
    found, depth = _Found(spark, name, buckets), 0
    try:
        level = found.add(start, depth)
        while not level.isEmpty() and (max_depth is None or depth < max_depth):
            depth += 1
            fresh = next_level(spark.table(f"{name}_edges"), level, found.all(), order)
            level = found.add(numbered(fresh, queue, "seq"), depth)
        last = last_level(leaves, found.all(), order, max_depth)
        every = found.all().select(*last.columns).unionByName(last)
        return materialize(numbered(every, ["level", *queue], "seq").select("url", "level", "from_url", "seq"), "levels")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_edges")
