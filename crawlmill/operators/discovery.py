"""URL discovery: first occurrence, known-URL test, and the rows it adds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill import limits as S
from crawlmill.functions.times import ntz
from crawlmill.functions.urls import site_of
from crawlmill.limits import NO_LIMITS, Limits
from crawlmill.operators.ranking import first_per_key


def first_discovery(links: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The first occurrence of every URL, within a page and across pages.

    ``order`` is the order in which the links were met, for instance parent's place in
    the queue, source and position.
    """
    return first_per_key(links, ["url"], order)


def unseen_urls(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates whose URL is not known yet."""
    return candidates.join(known.select("url"), "url", "left_anti")


def pages_by_url(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links with the id of the page they lead to, as ``target_id``; others go.

    ``pages(id, url)`` has unique URLs. Give a written table: Spark splits the links to a
    hot page only if both sides of the join are plain shuffles.
    """
    return links.join(pages.select("url", F.col("id").alias("target_id")), "url")


def new_sites(found: DataFrame, sites: DataFrame) -> DataFrame:
    """Domains of found URLs that have no site row."""
    return (
        found.select("domain").distinct()
        .join(sites.select("domain"), "domain", "left_anti")
    )


def new_links(candidates: DataFrame, links: DataFrame) -> DataFrame:
    """Links that the link table does not hold yet, each once."""
    key = ["from_page", "to_page"]
    return candidates.select(*key).distinct().join(links.select(*key), key, "left_anti")


@dataclass(frozen=True)
class Discovery:
    """What a batch of links adds to the crawl database.

    ``found`` has one row per new URL: ``url, domain, from_url`` and the order columns.
    The other tables are projections of it, so write ``found`` once and use those.
    ``rejected`` has the links that the caller's limits keep out, with ``reason``.
    """

    found: DataFrame
    sites: DataFrame
    as_of: datetime
    rejected: DataFrame | None = None

    def new_sites(self) -> DataFrame:
        return new_sites(self.found, self.sites)

    def new_pages(self) -> DataFrame:
        return self.found.select("url", "domain", F.lit("FRONTIER").alias("page_type_code"))

    def new_frontier(self) -> DataFrame:
        return self.found.select(
            "url", ntz(self.as_of).alias("time_added"), F.lit(False).alias("occupied")
        )

    def new_links(self) -> DataFrame:
        """The discovery tree: one link into every new page that a page led to."""
        return self.found.where(F.col("from_url").isNotNull()).select(
            "from_url", F.col("url").alias("to_url")
        )


def _texts(limits: Limits) -> dict[str, tuple[Column, int | None]]:
    return {"url": (F.col("url"), limits.url), "domain": (site_of(F.col("url")), limits.domain)}


def storable(links: DataFrame, limits: Limits = NO_LIMITS) -> DataFrame:
    """Links whose URL, and its domain, fit the page and site tables."""
    return S.fitting(links, _texts(limits))


def rejected(links: DataFrame, limits: Limits = NO_LIMITS) -> DataFrame:
    """Links that are left out because their URL or domain is too long, with ``reason``."""
    return S.rejected(links, _texts(limits))


def discover(
    links: DataFrame,
    known_pages: DataFrame,
    known_sites: DataFrame,
    order: Sequence[Column | str],
    as_of: datetime,
    limits: Limits = NO_LIMITS,
) -> Discovery:
    """Page links (``url, from_url`` and order columns) to new rows.

    First occurrence and known-URL test both work by URL, so they share one shuffle of
    the links, and that one comes after the per-task limit to one row per URL.
    """
    first = first_discovery(storable(links, limits), order)
    found = unseen_urls(first, known_pages).withColumn("domain", site_of(F.col("url")))
    return Discovery(found, known_sites, as_of, rejected(links, limits))


def seed_frontier(
    seeds: DataFrame, frontier: DataFrame, pages: DataFrame, as_of: datetime
) -> DataFrame:
    """Rows for the seed URLs, taken as they are; none unless the frontier is empty."""
    fresh = unseen_urls(first_per_key(seeds, ["url"], [F.col("seed_order")]), pages)
    if not frontier.isEmpty():
        fresh = fresh.limit(0)
    return fresh.select(
        "url", site_of(F.col("url")).alias("domain"),
        F.lit("FRONTIER").alias("page_type_code"), ntz(as_of).alias("time_added"),
    )
