"""Replay of a whole crawl over a static corpus.

The rounds of the replay are the levels of the crawl's queue: all URLs queued in one
round are judged, fetched, compared and expanded together, in queue order. Without
waiting times that gives the same tables as taking the URLs one by one from a
first-in-first-out queue. Robots delays change only when a page is fetched, which
``fetch_schedule`` tells; time is the round here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmill.functions.urls import site_of, with_canonical_url
from crawlmill.operators import links as L
from crawlmill.operators.content import content_verdicts
from crawlmill.operators.discovery import first_discovery, unseen_urls
from crawlmill.operators.ranking import first_per_key, numbered
from crawlmill.operators.robots import robots_policies, robots_verdicts, sitemap_urls
from crawlmill.operators.transitions import page_transitions
from crawlmill.plans.page_step import feature_links, page_features
from crawlmill.session import History, materialize, materialize_all

SITEMAP = 0  # sitemap URLs are queued before the links of the page that led there


@dataclass(frozen=True)
class Replay:
    # url, domain, page_type_code, http_status_code, content_hash, round
    pages: DataFrame
    # from_url, to_url
    links: DataFrame
    # url: still queued when the replay ended
    frontier: DataFrame


@dataclass(frozen=True)
class Corpus:
    """The static side of a replay, prepared once and written."""

    features: DataFrame  # url, status, has_body, content_hash
    links: DataFrame     # from_url, source, pos, url
    policies: DataFrame  # domain, rules, delay
    sitemaps: DataFrame  # domain, pos, url


def prepare_corpus(
    pages: DataFrame, sites: DataFrame, search_domains: Sequence[str] = ()
) -> Corpus:
    """``pages(page_id, url, html, status)`` and ``sites(domain, robots_content, sitemap_content)``.

    Pages are looked up by canonical URL; of pages that share one, the first counts.
    Several sitemaps of a domain may come in several rows.
    """
    own = pages.select(
        "page_id", F.col("url").alias("_raw"), "html", "status",
        F.lit("").alias("_scheme0"), F.lit("").alias("_host0"),
    )
    keyed = with_canonical_url(own, "_raw", "_scheme0", "_host0").select(
        "page_id", "url", "html", "status"
    )
    features = materialize(page_features(keyed, ("page_id",)), "replay-features")
    chosen = first_per_key(features.select("url", "page_id"), ["url"], [F.col("page_id")])
    features = features.join(chosen.select("page_id"), "page_id", "left_semi")
    links = L.page_links(feature_links(features, ("page_id",), search_domains))
    policies = robots_policies(
        sites.groupBy("domain").agg(F.max("robots_content").alias("robots_content"))
    )
    located = sitemap_urls(
        sites.where(F.col("sitemap_content").isNotNull()), search_domains, ("domain",)
    )
    return Corpus(**materialize_all(
        features=features.select("url", "status", "has_body", "content_hash"),
        links=links.select("from_url", "source", "pos", "url"),
        policies=policies,
        sitemaps=located,
    ))


def replay(
    corpus: Corpus,
    seeds: DataFrame,
    max_rounds: int | None = None,
    final_dequeue: bool = True,
) -> Replay:
    """Crawl the corpus from ``seeds(url, seed_order)`` until the queue is empty.

    A URL outside the corpus gives no response. ``final_dequeue`` removes every processed
    page from the queue. Without it failed pages are queued again, those without a
    response for ever, so ``max_rounds`` is needed then.
    """
    if not final_dequeue and max_rounds is None:
        raise ValueError("max_rounds is needed if failed pages are queued again")
    spark = seeds.sparkSession
    queues, outcomes = History(spark, "replay-queue"), History(spark, "replay-outcome")
    start = first_discovery(seeds, ["seed_order"]).select(
        "url", site_of(F.col("url")).alias("domain"),
        F.lit(None).cast("string").alias("from_url"),
        F.lit("FRONTIER").alias("old_type"), F.lit(None).cast("int").alias("old_status"),
        F.lit(True).alias("new"), "seed_order",
    )
    queue = queues.add(numbered(start, ["seed_order"], "seq").drop("seed_order"))
    visited = None
    while not queue.isEmpty() and (max_rounds is None or len(outcomes) < max_rounds):
        outcome = outcomes.add(_judge(
            corpus, queue, outcomes.all() if outcomes else None, final_dequeue
        ).withColumn("round", F.lit(len(outcomes))))
        visits = _first_visits(queue, visited)
        visited = queues.all().select("domain")
        following = _next_queue(corpus, outcome, visits, queues.all())
        queue = queues.add(following)
    return _result(queues.all(), outcomes.all() if outcomes else None, queue)


def _judge(
    corpus: Corpus, queue: DataFrame, earlier: DataFrame | None, final_dequeue: bool
) -> DataFrame:
    """Verdicts and new page values for one round of the queue."""
    asked = queue.select("url", "domain", "seq", "old_type", "old_status")
    judged = robots_verdicts(asked, corpus.policies).join(corpus.features, "url", "left")
    allowed = F.col("allowed")
    fetched = judged.withColumns({
        "status": F.when(allowed, F.col("status")),
        "content_hash": F.when(allowed, F.col("content_hash")),
    })
    compared = content_verdicts(fetched, ("seq",), earlier, key="url")
    moved = page_transitions(
        compared.withColumn("is_dup", F.col("page_type_code") == "DUPLICATE"), final_dequeue
    )
    return moved.select(
        "url", "domain", "seq",
        F.when(allowed, F.col("page_type_code")).otherwise("FORBIDDEN").alias("page_type_code"),
        F.when(allowed, F.col("http_status_code")).alias("http_status_code"),
        F.when(F.col("store_content"), F.col("content_hash")).alias("content_hash"),
        (allowed & F.col("requeue")).alias("requeue"),
        (allowed & F.col("store_content")).alias("store_content"),
    )


def _first_visits(queue: DataFrame, visited: DataFrame | None) -> DataFrame:
    """Domains met for the first time, with the place of the URL that led there."""
    met = queue.groupBy("domain").agg(F.min("seq").alias("_parent"))
    if visited is None:
        return met
    return met.join(visited.distinct(), "domain", "left_anti")


def _next_queue(
    corpus: Corpus, outcome: DataFrame, visits: DataFrame, queued: DataFrame
) -> DataFrame:
    """New URLs of the sitemaps and links, and those to be tried again, in queue order."""
    no_parent = F.lit(None).cast("string").alias("from_url")
    parents = outcome.where(F.col("store_content")).select(
        F.col("url").alias("from_url"), F.col("seq").alias("_parent")
    )
    followed = corpus.links.join(parents, "from_url")
    located = corpus.sitemaps.join(visits, "domain").select(
        no_parent, F.lit(SITEMAP).alias("source"), "pos", "url", "_parent"
    )
    order = ["_parent", "source", "pos"]
    found = first_discovery(followed.unionByName(located), order)
    fresh = unseen_urls(found, queued).withColumns({
        "old_type": F.lit("FRONTIER"), "old_status": F.lit(None).cast("int"), "new": F.lit(True),
    })
    again = outcome.where(F.col("requeue")).select(
        no_parent, F.lit(SITEMAP).alias("source"), F.lit(-1).alias("pos"), "url",
        F.col("seq").alias("_parent"), F.col("page_type_code").alias("old_type"),
        F.col("http_status_code").alias("old_status"), F.lit(False).alias("new"),
    )
    # The URL orders what several sitemaps of a domain have at the same place.
    return numbered(fresh.unionByName(again), [*order, "url"], "seq").select(
        "url", site_of(F.col("url")).alias("domain"), "from_url", "old_type", "old_status",
        "new", "seq",
    )


def _result(queued: DataFrame, outcomes: DataFrame | None, rest: DataFrame) -> Replay:
    values = ["url", "domain", "page_type_code", "http_status_code", "content_hash", "round"]
    pages = rest.where(F.col("new")).select(
        "url", "domain", F.col("old_type").alias("page_type_code"),
        F.col("old_status").alias("http_status_code"),
        F.lit(None).cast("string").alias("content_hash"), F.lit(None).cast("int").alias("round"),
    )
    if outcomes is not None:
        last = first_per_key(outcomes.select(*values), ["url"], [F.col("round").desc()])
        pages = last.unionByName(pages)
    links = queued.where(F.col("new") & F.col("from_url").isNotNull()).select(
        "from_url", F.col("url").alias("to_url")
    )
    return Replay(pages, links, rest.select("url"))
