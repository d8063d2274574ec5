"""The frontier: eligible pages, next pages, fetch schedule."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.constants import DEFAULT_CRAWL_DELAY
from crawlmill.functions.times import ntz, plus_seconds
from crawlmill.operators.ranking import first_n_per_key, rank_in_group


def queue_order() -> list[Column]:
    """Oldest first, rows without a time last, page id against ties."""
    return [F.col("time_added").asc_nulls_last(), F.col("page_id").asc()]


def accessible_sites(sites: DataFrame, as_of: datetime) -> DataFrame:
    """Sites that may be accessed at ``as_of``."""
    return sites.where(F.col("next_acces").isNull() | (F.col("next_acces") <= ntz(as_of)))


def ready_pages(
    frontier: DataFrame, pages: DataFrame, sites: DataFrame, as_of: datetime
) -> DataFrame:
    """Frontier rows that are free and whose site may be accessed, with ``site_id``.

    Written as inner join and semi join: a page without a row cannot pass the site test.
    """
    free = frontier.where(~F.col("occupied"))
    open_sites = accessible_sites(sites, as_of).select(F.col("id").alias("site_id"))
    narrow = pages.select(F.col("id").alias("page_id"), "site_id")
    return free.join(narrow, "page_id", "inner").join(open_sites, "site_id", "left_semi")


def next_pages(ready: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` oldest ready rows (a distributed top-n, no global sort)."""
    return ready.orderBy(*queue_order()).limit(n)


def occupy(frontier: DataFrame, popped: DataFrame) -> DataFrame:
    """The frontier in which the popped rows are marked as occupied."""
    marks = popped.select("page_id", F.lit(True).alias("_popped"))
    return (
        frontier.join(marks, "page_id", "left")
        .withColumn("occupied", F.col("occupied") | F.coalesce(F.col("_popped"), F.lit(False)))
        .drop("_popped")
    )


def next_batch(ready: DataFrame, per_site: int) -> DataFrame:
    """The ``per_site`` oldest ready rows of every site, with their rank."""
    return first_n_per_key(ready, ["site_id"], queue_order(), per_site, "site_rank")


def fetch_schedule(
    urls: DataFrame,
    sites: DataFrame,
    as_of: datetime,
    default_delay: int = DEFAULT_CRAWL_DELAY,
) -> DataFrame:
    """When each allowed URL may be fetched: adds ``site_rank`` and ``fetch_time``.

    ``urls(page_id, site_id, time_added, ...)`` joins ``sites(id, next_acces, delay)``. The
    i-th URL of a site is due ``(i - 1) * delay`` seconds after the site opens. This is
    the closed form of asking again and again with a moving next access time. A site without
    a row is open and has the default delay.
    """
    ranked = rank_in_group(urls, "site_id", queue_order(), "site_rank")
    timing = sites.select(F.col("id").alias("site_id"), "next_acces", "delay")
    opens = F.greatest(F.coalesce(F.col("next_acces"), ntz(as_of)), ntz(as_of))
    delay = F.coalesce(F.col("delay"), F.lit(default_delay)).cast("long")
    wait = (F.col("site_rank") - 1) * delay
    return (
        ranked.join(timing, "site_id", "left")
        .withColumn("fetch_time", plus_seconds(opens, wait))
        .drop("next_acces", "delay")
    )


def release(frontier: DataFrame) -> DataFrame:
    """All rows free again, as at a start after a crash."""
    return frontier.withColumn("occupied", F.lit(False))


def give_back(frontier: DataFrame, delayed: DataFrame) -> DataFrame:
    """Delayed rows free again; their place in the queue stays."""
    marks = delayed.select("page_id", F.lit(True).alias("_delayed"))
    return (
        frontier.join(marks, "page_id", "left")
        .withColumn("occupied", F.col("occupied") & F.col("_delayed").isNull())
        .drop("_delayed")
    )


def remove(frontier: DataFrame, processed: DataFrame) -> DataFrame:
    """The frontier without the processed pages."""
    return frontier.join(processed.select("page_id"), "page_id", "left_anti")


def requeue(frontier: DataFrame, again: DataFrame, as_of: datetime) -> DataFrame:
    """Pages that are queued again go to the end: removed and added as of now."""
    fresh = again.select(
        "page_id", ntz(as_of).alias("time_added"), F.lit(False).alias("occupied")
    )
    return remove(frontier, again).select("page_id", "time_added", "occupied").unionByName(fresh)
