"""Reports over the crawl tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def link_graph(links: DataFrame, pages: DataFrame) -> DataFrame:
    """All links between known pages, each pair once: ``from_url, to_url``."""
    pairs = links.select("from_url", F.col("url").alias("to_url")).distinct()
    return pairs.join(pages.select(F.col("url").alias("to_url")), "to_url", "left_semi").select(
        "from_url", "to_url"
    )


def degrees(graph: DataFrame) -> DataFrame:
    """Links out of and into every page of the graph: ``url, out_degree, in_degree``."""
    ends = F.explode(F.array(
        F.struct(F.col("from_url").alias("url"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("to_url").alias("url"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    ))
    return graph.select(ends.alias("end")).groupBy(F.col("end.url").alias("url")).agg(
        F.sum("end.o").alias("out_degree"), F.sum("end.i").alias("in_degree")
    )


def crawl_report(pages: DataFrame) -> DataFrame:
    """Pages per site, type and status, with totals per site and over all (rollup)."""
    return pages.rollup("domain", "page_type_code", "http_status_code").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.grouping_id().alias("level"),
    )
