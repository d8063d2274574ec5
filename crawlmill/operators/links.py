"""Link extraction: from page markup to canonical, classified URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill import constants as C
from crawlmill.functions import html as H
from crawlmill.functions.references import decode_entities
from crawlmill.functions.urls import url_netloc, url_scheme, with_canonical_url

# Order in which a page's links are taken: first href, then onclick, then images.
HREF, ONCLICK, IMAGE = 1, 2, 3
PAGE, DOCUMENT, PICTURE = "page", "binary", "image"

_SOURCES = {HREF: ("hrefs", H.HREF), ONCLICK: ("onclicks", H.ONCLICK), IMAGE: ("images", H.IMG_SRC)}


def page_bodies(pages: DataFrame) -> DataFrame:
    """Pages with their head removed as ``body``; pages without a body element go."""
    return (
        pages.where(H.has_body(F.col("html")))
        .withColumn("body", H.page_body(F.col("html")))
        .drop("html")
    )


def link_arrays(
    pages: DataFrame, keep: Sequence[str], sources: Sequence[int] = (HREF, ONCLICK, IMAGE)
) -> DataFrame:
    """Raw attribute values per page as arrays, in one narrow pass over the markup.

    The markup itself is not carried on, so nothing wide reaches a later shuffle.
    """
    visible = pages.select(
        *keep, F.col("url").alias("from_url"), H.visible_markup(F.col("html")).alias("_markup")
    )
    # Not a filter: Catalyst would push it below and clean the markup twice.
    markup = F.when(H.contains_body_tag(F.col("_markup")), F.col("_markup"))
    return visible.select(
        *keep,
        "from_url",
        url_scheme(F.col("from_url")).alias("scheme"),
        url_netloc(F.col("from_url")).alias("host"),
        *[
            H.attribute_values(markup, pattern).alias(name)
            for source, (name, pattern) in _SOURCES.items()
            if source in sources
        ],
    )


def raw_links(
    arrays: DataFrame, keep: Sequence[str], sources: Sequence[int] = (HREF, ONCLICK, IMAGE)
) -> DataFrame:
    """One row per attribute value: ``source``, ``pos`` (document order), ``raw``."""
    carried = [*keep, "from_url", "scheme", "host"]
    per_source = F.array(*[
        F.struct(F.lit(source).alias("source"), F.col(_SOURCES[source][0]).alias("found"))
        for source in sources
    ])
    return (
        arrays.select(*carried, F.explode(per_source).alias("_s"))
        .select(*carried, F.col("_s.source").alias("source"), F.posexplode("_s.found"))
        .select(
            *carried, "source", "pos",
            decode_entities(H.unquote_value(F.col("col"))).alias("raw"),
        )
    )


def onclick_target(script: Column) -> Column:
    """URL text of a navigating script, NULL if the script does not navigate."""
    assignment = F.regexp_extract(script, C.ONCLICK_ASSIGNMENT, 0)
    target = F.replace(F.replace(script, assignment, F.lit("")), F.lit("'"), F.lit(""))
    return F.when(assignment != "", target)


def link_class(url: Column, source: Column, raw: Column) -> Column:
    """``page``, ``binary`` or ``image``; NULL drops the link.

    The list of unwanted extensions and the e-mail test hold for href links only.
    """
    extension = F.lower(F.regexp_extract(url, C.URL_EXTENSION, 1))
    href = source == HREF
    return (
        F.when(url.isNull(), None)
        .when(source == IMAGE, F.when(url.rlike(C.IMAGE_URL), PICTURE))
        .when(href & raw.rlike(C.BARE_EMAIL), None)
        .when(href & url.rlike(C.IGNORED_URL), None)
        .when(url.rlike(C.DOCUMENT_URL), DOCUMENT)
        .when(href & extension.isin(*C.DROPPED_EXTENSIONS), None)
        .otherwise(PAGE)
    )


def classified_links(
    raw: DataFrame, search_domains: Sequence[str] = ()
) -> DataFrame:
    """Canonical URL and class of every raw link that is worth keeping.

    Images are accepted from any host, other links only within ``search_domains``.
    Rows are dropped by a generator instead of a filter: a filter, here or in a later
    operator, would be pushed below the projections and repeat all their work.
    """
    source = F.col("source")
    target = F.when(source == ONCLICK, onclick_target(F.col("raw"))).otherwise(F.col("raw"))
    resolved = with_canonical_url(
        raw.withColumn("_target", target), "_target", "scheme", "host",
        search_domains, any_host=source == IMAGE,
    )
    kept = [c for c in raw.columns if c not in ("scheme", "host")]
    verdict = link_class(F.col("url"), source, F.col("raw"))
    return (
        resolved.withColumn("cls", verdict)
        .select(
            *kept,
            F.explode(
                F.when(F.col("cls").isNotNull(), F.array(F.struct("url", "cls")))
            ).alias("_link"),
        )
        .select(*kept, "_link.url", "_link.cls")
    )


def extract_links(
    pages: DataFrame,
    search_domains: Sequence[str] = (),
    keep: Sequence[str] = ("page_id",),
    sources: Sequence[int] = (HREF, ONCLICK, IMAGE),
) -> DataFrame:
    """All kept links of ``pages(url, html, keep...)``.

    Result: keep..., ``from_url, source, pos, raw, url, cls``. There is no shuffle; the
    order of a page's links is ``(source, pos)``.
    """
    arrays = link_arrays(pages, keep, sources)
    return classified_links(raw_links(arrays, keep, sources), search_domains)


def page_links(links: DataFrame) -> DataFrame:
    """Links to further pages: the href links followed by the onclick links."""
    return links.where(F.col("cls") == PAGE)
