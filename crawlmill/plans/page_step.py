"""One processing step for a batch of responses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmill.functions import html as H
from crawlmill.functions.times import ntz
from crawlmill.functions.urls import url_netloc, url_scheme
from crawlmill.operators import assets, links as L
from crawlmill.operators.content import content_verdicts
from crawlmill.operators.discovery import Discovery, discover
from crawlmill.operators.store import Payloads, read_wanted
from crawlmill.operators.transitions import page_state, page_transitions
from crawlmill.session import materialize

LINK_COLUMNS = ("scheme", "host", "hrefs", "onclicks", "images")


def page_features(
    pages: DataFrame, keep: Sequence[str], with_body: bool = False
) -> DataFrame:
    """Everything the step needs from a page, in one pass over its markup.

    Input: keep..., ``url, html, status``. Markup counts only for good responses. Result:
    keep..., ``url, status, has_body, content_hash`` and the raw link arrays, and
    on request the page without its head as ``html_content``.
    """
    good = F.when(page_state(F.col("status")) == "ok", F.col("html"))
    visible = pages.select(
        *keep, "url", "status", good.alias("_html"), H.visible_markup(good).alias("_markup")
    ).withColumn("has_body", H.contains_body_tag(F.col("_markup")))
    markup = F.when(F.col("has_body"), F.col("_markup"))
    return visible.select(
        *keep, "url", "status", "has_body",
        F.when(F.col("has_body"), H.content_hash(F.col("_html"))).alias("content_hash"),
        *([F.when(F.col("has_body"), H.page_body(F.col("_html"))).alias("html_content")] if with_body else []),
        url_scheme(F.col("url")).alias("scheme"),
        url_netloc(F.col("url")).alias("host"),
        H.attribute_values(markup, H.HREF).alias("hrefs"),
        H.attribute_values(markup, H.ONCLICK).alias("onclicks"),
        H.attribute_values(markup, H.IMG_SRC).alias("images"),
    )


def feature_links(
    features: DataFrame, keep: Sequence[str], search_domains: Sequence[str] = ()
) -> DataFrame:
    """Classified links of feature rows (see :func:`crawlmill.operators.links.extract_links`)."""
    arrays = features.select(*keep, F.col("url").alias("from_url"), *LINK_COLUMNS)
    return L.classified_links(L.raw_links(arrays, keep), search_domains)


@dataclass(frozen=True)
class BatchResult:
    """Changes a batch makes to the crawl tables."""

    # page_id, url, page_type_code, http_status_code, content_hash, accessed_time,
    # requeue, store_content
    pages: DataFrame
    discovery: Discovery
    documents: DataFrame
    images: DataFrame
    features: DataFrame

    def contents(self) -> DataFrame:
        """``page_id, html_content``: the bodies without head of the pages whose content is stored.

        They were written with the features, before anything was known about copies; the verdicts
        choose among the written rows, and no markup is joined or shuffled.
        """
        stored = self.pages.where("store_content")
        return read_wanted(self.features, "page_id", stored, ["page_id", "html_content"])

    def frontier_removed(self) -> DataFrame:
        return self.pages.where(~F.col("requeue")).select("page_id")


def process_batch(
    batch: DataFrame,
    known_pages: DataFrame,
    known_sites: DataFrame,
    known_hashes: DataFrame | None,
    as_of: datetime,
    search_domains: Sequence[str] = (),
    final_dequeue: bool = False,
    files: Payloads | None = None,
) -> BatchResult:
    """Process ``batch(page_id, url, html, status, old_type, old_status)``.

    Pages are taken in the order of their ids. The markup is read once; its features and the
    body that may be stored are written side by side. The features pass the one join that
    brings the verdict, so links are taken from the joined rows without another shuffle. The
    bodies stay where they are until :meth:`BatchResult.contents` reads those that are stored.
    """
    keep = ("page_id", "old_type", "old_status")
    features = materialize(page_features(batch, keep, with_body=True), "features")
    verdicts = content_verdicts(features.drop("html_content"), ("page_id",), known_hashes, key="page_id")
    judged = page_transitions(
        verdicts.withColumn("is_dup", F.col("page_type_code") == "DUPLICATE"),
        final_dequeue,
    )
    judged = materialize(judged, "judged")
    stored = F.col("store_content")
    fetched = F.col("status").isNotNull()
    pages = judged.select(
        "page_id", "url", "page_type_code", "http_status_code",
        F.when(stored, F.col("content_hash")).alias("content_hash"),
        F.when(fetched, ntz(as_of)).alias("accessed_time"),
        "requeue", "store_content",
    )
    links = materialize(
        feature_links(judged.where(stored), ("page_id",), search_domains), "links"
    )
    order = [F.col("page_id"), F.col("source"), F.col("pos")]
    discovery = discover(L.page_links(links), known_pages, known_sites, order, as_of)
    return BatchResult(
        pages,
        Discovery(materialize(discovery.found, "found"), known_sites, as_of),
        assets.document_rows(links, files),
        assets.image_rows(links, as_of, files),
        features,
    )
