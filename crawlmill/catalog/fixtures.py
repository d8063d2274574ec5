"""Crawl tables derived from the given tables, for the registered queries.

The given tables hold no robots files, sitemaps, statuses or assets. These rules derive
them from the rows that are there, so the derived tables grow with the given ones. The
texts and rules are stated once here; the check SQL uses the same texts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmill.functions.times import ntz
from crawlmill.functions.urls import url_netloc, url_scheme, with_canonical_url

AS_OF = datetime(2024, 1, 15)
OPENED = datetime(2024, 1, 14)
OPENS_LATER = datetime(2024, 1, 16)

# Suffixes as search domains; the dot is a wild card on purpose.
SEARCH_DOMAINS = ["example.org", "ex.mple.com"]

# Robots text by host prefix; hosts that fit no prefix have none yet.
ROBOTS = (
    ("m.", "User-agent: *\nDisallow: /en/\nCrawl-delay: 86400\nSitemap: http://m.example.org/map.xml  \n"),
    ("www.", "User-agent: bot\nDisallow: /\n\nUser-agent: x\nUser-agent: *\n# note\n \n"
             "Allow: /en/1\nDisallow: /en/\nCrawl-delay: 3\nCrawl-delay: 0.5\n\n"
             "User-agent: *\nDisallow: /\nSitemap:none\nSitemap: http://www.example.org/a.xml\r\n"
             "Sitemap: http://www.example.org/b.xml\n"),
    ("blog.", ""),
    ("th", "Disallow: /\nUser-Agent: *\nAllow: /de/ # first\nDisallow: /d\nDisallow: /fr/%31\n"
           "Disallow: /a?b=*\nCrawl-delay: 0\n\nDisallow: /es/\n"),
    ("tion", "User-agent: *\nDisallow: /\n\nUser-agent:\nAllow: /en/\nDisallow: /e\nDisallow:\n"
             "Crawl-delay: 12\n"),
)
# What the first visit of a host without robots text finds.
FETCHED_ROBOTS = "User-agent: *\nDisallow: /es/\nCrawl-delay: 9\n"

# Markup put behind every page; {id} is the page id.
EXTRA_MARKUP = (
    '<img src="/i/{id}.PNG"><img alt="p" src=\'http://cdn.example.net/p.1/{id}.jpeg\'>'
    '<img src="/i/{id}.gif"><a href="/f/{id}.pdf">d</a><a href="/f/{id}.Pdf">d</a>'
    '<a class="doc" href=\'/f/{id}.DOCX\'>d</a><a href="/f/{id}.pptX/">d</a>'
    '<a href="/v/{id}.mp4">v</a><a href="/v/{id}.mp3">v</a><a href="/x/{id}.xls">x</a>'
    '<a href="mailto:a@b.si">m</a><a href="info@bč.si">m</a><a href="javascript:go()">j</a>'
    '<a href="../up/./a/../{id}/index.html?x=1#top">u</a><a href="#top">t</a>'
    '<a href="//CDN.example.org:80/a b/é%c3%a9/{id}&amp;~*">s</a>'
    '<a href="http://cdn.example.net/n/{id}">n</a><a href="http://Docs.example.org/{id}">n</a>'
    '<span onclick="location.href=\'/o/{id}\'">o</span>'
    '<span onclick="window.location=\'/o/{id}.pdf\'">p</span>'
    '<span onclick="document.location.href=\'/o/{id}.xls\';">q</span>'
    '<span onclick="location.href = \'/w\'">w</span><span onclick="window.open(\'/w\')">w</span>'
    '<link href="/l/{id}"><!-- <a href="/hidden/{id}">h</a> -->'
    '<script>var s = "<a href=\'/hidden/{id}\'>";</script>'
    '<a href="/r/&eacute;&#233;&#x00000000E9;/&scaron;{id}">r</a><a href="/r/&#38;lt;&#150;&copy/{id}">r</a>'
    '<span onclick="location.href=&#39;/r/&amp;&#38;amp;/&ouml{id}&#39;">r</a></span>'
    '<img src="/r/&Auml;&#xfc;{id}.png">'
)
# The character references above and what they mean, as a reader of HTML decodes them once.
REFERENCES = (
    ("&eacute;", "é"), ("&#233;", "é"), ("&#x00000000E9;", "é"), ("&scaron;", "š"), ("&#38;", "&"),
    ("&#150;", "–"), ("&copy", "©"), ("&#39;", "'"), ("&amp;", "&"), ("&ouml", "ö"),
    ("&Auml;", "Ä"), ("&#xfc;", "ü"), ("&#x73;", "s"), ("&ntilde;", "ñ"),
)
# Markup of every page whose id leaves LONG_REST when divided by LONG_STEP: names that no column of a
# crawl database holds.
LONG_STEP, LONG_REST = 50, 7
LONG_NAME = "x" * 3100
LONG_MARKUP = (
    f'<a href="/long/{LONG_NAME}/{{id}}">l</a><a href="/long/{LONG_NAME}/{{id}}.pdf">l</a>'
    f'<img src="/long/{LONG_NAME[:300]}{{id}}.png">'
)

# The same markup as one writes it in one way only.
EXTRA_NORMAL = (
    '<img src="/i/{id}.PNG"/><img alt="p" src="http://cdn.example.net/p.1/{id}.jpeg"/>'
    '<img src="/i/{id}.gif"/><a href="/f/{id}.pdf">d</a><a href="/f/{id}.Pdf">d</a>'
    '<a class="doc" href="/f/{id}.DOCX">d</a><a href="/f/{id}.pptX/">d</a>'
    '<a href="/v/{id}.mp4">v</a><a href="/v/{id}.mp3">v</a><a href="/x/{id}.xls">x</a>'
    '<a href="mailto:a@b.si">m</a><a href="info@bč.si">m</a><a href="javascript:go()">j</a>'
    '<a href="../up/./a/../{id}/index.html?x=1#top">u</a><a href="#top">t</a>'
    '<a href="//CDN.example.org:80/a b/é%c3%a9/{id}&amp;~*">s</a>'
    '<a href="http://cdn.example.net/n/{id}">n</a><a href="http://Docs.example.org/{id}">n</a>'
    '<span onclick="location.href=\'/o/{id}\'">o</span>'
    '<span onclick="window.location=\'/o/{id}.pdf\'">p</span>'
    '<span onclick="document.location.href=\'/o/{id}.xls\';">q</span>'
    '<span onclick="location.href = \'/w\'">w</span><span onclick="window.open(\'/w\')">w</span>'
    '<link href="/l/{id}"/><!-- <a href="/hidden/{id}">h</a> -->'
    '<script>var s = "<a href=\'/hidden/{id}\'>";</script>'
    '<a href="/r/ééé/š{id}">r</a><a href="/r/&amp;lt;–©/{id}">r</a>'
    '<span onclick="location.href=\'/r/&amp;&amp;amp;/ö{id}\'">r</a></span>'
    '<img src="/r/Äü{id}.png"/>'
)
LONG_NORMAL = LONG_MARKUP.replace('.png">', '.png"/>')
# How every fifth page spells its markup, by the rest of its id: what is replaced by what, as patterns.
SPELLINGS = (
    (),
    (("<p>", "<P >"), ("</p>", "</P\n>"), ("<(li|div|nav)", "<$1\t")),
    (('<a href="([^"]*)">', "<A HREF = '$1' >"), ('<div class="ad">', "<DIV CLASS=ad>")),
    (("<br>", "<br />"), ("<(b|h1)>", "<$1\n>"), ("</(b|h1)>", "</$1 >")),
    (("&amp;", "&#38;"), ("é", "&eacute;"), ("&middot;", "&#xB7;")),
)

TREE = 4  # source of the links between pages, after href, onclick and image
SITEMAP_BLOCK = 1000  # pages per sitemap file
SITEMAP_HEAD = '<?xml version="1.0"?><urlset>'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def third_of(key: Column, low: int, span: int) -> Column:
    """0, 1 or 2 by the place of a number in its range."""
    return F.when(key <= low + span // 3, 0).when(key <= low + 2 * span // 3, 1).otherwise(2)


def comes_later(site: Column) -> Column:
    return site % 4 == 1


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def canonical_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, raw, url, domain`` with the canonical URL of every page."""
    own = pages(spark, sf_dir).select(
        "page_id", F.col("url").alias("raw"),
        url_scheme(F.col("url")).alias("scheme"), url_netloc(F.col("url")).alias("domain"),
    )
    return with_canonical_url(own, "raw", "scheme", "domain").select(
        "page_id", "raw", "url", "domain"
    )


def robots_text(domain: Column) -> Column:
    prefix, text = ROBOTS[0]
    chosen = F.when(domain.startswith(prefix), text)
    for prefix, text in ROBOTS[1:]:
        chosen = chosen.when(domain.startswith(prefix), text)
    return chosen


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per host: ``id`` is the host's first page id."""
    hosts = (
        pages(spark, sf_dir).groupBy(url_netloc(F.col("url")).alias("domain"))
        .agg(F.min("page_id").alias("id"))
    )
    robots = robots_text(F.col("domain"))
    access = F.when(F.col("id") % 2 == 0, ntz(OPENED)).otherwise(ntz(OPENS_LATER))
    return hosts.select(
        "id", "domain", robots.alias("robots_content"),
        F.lit(None).cast("string").alias("sitemap_content"),
        F.when(robots.isNotNull(), access).alias("next_acces"),
        F.when(robots.isNotNull(), F.col("id") % 5 + 2).cast("int").alias("delay"),
    )


def fetched_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sites(spark, sf_dir).where(F.col("robots_content").isNull())
        .select("domain", F.lit(FETCHED_ROBOTS).alias("robots_content"),
                F.lit(None).cast("string").alias("sitemap_content"))
    )


def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap responses of every host, each with at most ``SITEMAP_BLOCK`` pages.

    Files with an odd number of a host that begins with "th" are missing on the server.
    """
    block = F.floor(F.col("page_id") / SITEMAP_BLOCK).cast("long")
    listed = F.array_sort(F.collect_list(F.struct("page_id", "url")))
    urls = F.transform(listed, lambda p: F.concat(F.lit("<url><loc>"), p["url"], F.lit("</loc></url>")))
    invented = F.concat(
        F.lit("<url><LOC>/only-in-sitemap/"), F.col("block").cast("string"),
        F.lit("</LOC></url><image:loc>/no</image:loc>"
              "<loc>http://elsewhere.example.org/s</loc><loc>ftp://f.example.org/s</loc>"
              "<loc>http://elsewhere.example.org/&#x73;&ntilde;&amp;&#38;lt;</loc>"),
    )
    return (
        pages(spark, sf_dir)
        .groupBy(url_netloc(F.col("url")).alias("domain"), block.alias("block"))
        .agg(urls.alias("urls"))
        .select("domain", "block", F.concat(
            F.lit(SITEMAP_HEAD), F.array_join("urls", ""), invented
        ).alias("sitemap_content"), sitemap_status(F.col("domain"), F.col("block")).alias("status"))
    )


def sitemap_status(domain: Column, block: Column) -> Column:
    return F.when(domain.startswith("th") & (block % 2 == 1), 404).otherwise(200)


def tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binary tree over the page ids, with links in both directions: ``src, dst``."""
    child = pages(spark, sf_dir).where(F.col("page_id") > 0).select("page_id")
    parent = F.floor((F.col("page_id") - 1) / 2).cast("long")
    both = F.array(
        F.struct(parent.alias("src"), F.col("page_id").alias("dst")),
        F.struct(F.col("page_id").alias("src"), parent.alias("dst")),
    )
    return child.select(F.explode(both).alias("e")).select("e.src", "e.dst")


def tree_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree as raw links behind all others of a page, for the given pages do not link
    to each other. Only ids and URLs are joined."""
    own = pages(spark, sf_dir).select(
        F.col("page_id").alias("dst"), F.col("url").alias("raw")
    )
    base = pages(spark, sf_dir).select(
        "page_id", F.col("url").alias("from_url"), url_scheme(F.col("url")).alias("scheme"),
        url_netloc(F.col("url")).alias("host"),
    )
    edges = tree_edges(spark, sf_dir).withColumnRenamed("src", "page_id")
    near = F.greatest(F.col("dst") - 2 * F.col("page_id"), F.lit(0)).cast("int")
    return edges.join(own, "dst").join(base, "page_id").select(
        "page_id", "from_url", "scheme", "host", F.lit(TREE).alias("source"),
        near.alias("pos"), "raw",
    )


def enriched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with more markup behind them."""
    page_id = F.col("page_id")
    extra = F.concat(F.lit(EXTRA_MARKUP), F.when(has_long_names(page_id), LONG_MARKUP).otherwise(""))
    extra = F.replace(extra, F.lit("{id}"), page_id.cast("string"))
    return pages(spark, sf_dir).select("page_id", "url", F.concat("html", extra).alias("html"))


def has_long_names(page_id: Column) -> Column:
    return page_id % LONG_STEP == LONG_REST


def status_of(page_id: Column) -> Column:
    last = page_id % 10
    return F.when(last == 1, 404).when(last == 2, 500).when(last != 0, 200).cast("int")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched pages as responses: every tenth none, some errors, some repeated."""
    page_id = F.col("page_id")
    return enriched_pages(spark, sf_dir).select(
        "*", status_of(page_id).alias("status"),
        F.lit("FRONTIER").alias("old_type"),
        F.when(page_id % 20 == 1, 404).cast("int").alias("old_status"),
    )


def respelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, each in one of five spellings of its markup."""
    html, rest = F.col("html"), F.col("page_id") % len(SPELLINGS)
    spelled = F.when(rest == 0, html)
    for number, spelling in enumerate(SPELLINGS[1:], 1):
        text = html
        for pattern, other in spelling:
            text = F.regexp_replace(text, pattern, other)
        spelled = spelled.when(rest == number, text)
    return pages(spark, sf_dir).select("page_id", spelled.alias("html"))


def canonical_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses under the canonical URLs of their pages; the markup passes no join."""
    own = responses(spark, sf_dir).withColumnRenamed("url", "raw").withColumns({
        "scheme": url_scheme(F.col("raw")), "domain": url_netloc(F.col("raw")),
    })
    return with_canonical_url(own, "raw", "scheme", "domain").select(
        "page_id", "url", "html", "status", "old_type", "old_status"
    )


def link_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files behind some of the links: the page's own text as PDF and as image."""
    page_id = F.col("page_id").cast("string")
    origin = F.concat(url_scheme(F.col("url")), F.lit("://"), url_netloc(F.col("url")))
    names = [("/f/", ".pdf"), ("/i/", ".PNG")]
    long_names = [(f"/long/{LONG_NAME}/", ".pdf"), (f"/long/{LONG_NAME[:300]}", ".png")]
    urls = lambda parts: F.array(*[F.concat(origin, F.lit(a), page_id, F.lit(b)) for a, b in parts])
    return enriched_pages(spark, sf_dir).select(
        F.encode("html", "UTF-8").alias("content"),
        F.explode(
            F.when(has_long_names(F.col("page_id")), urls(names + long_names)).otherwise(urls(names))
        ).alias("url"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as page contents: ``id, text``; many are exact copies."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def document_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the bodies of pages, in two spellings; every tenth page has no body element."""
    page_id = F.col("doc_id")
    title = F.concat(F.lit("<html><head><title>"), page_id.cast("string"), F.lit("</title></head>"))
    body = lambda start, end: F.concat(title, F.lit(start), F.coalesce("text", F.lit("")), F.lit(end))
    html = (
        F.when(page_id % 10 == 3, body("<div><p>", "</p></div></html>"))
        .when(page_id % 2 == 0, body("<BODY >\n<P>", " </P\n></BODY></html>"))
        .otherwise(body("<body><p>", "</p></body></HTML>"))
    )
    return table(spark, sf_dir, "documents").select(
        page_id.alias("page_id"), F.concat(F.lit("http://documents.example.org/"), page_id.cast("string")).alias("url"),
        html.alias("html"), status_of(page_id).alias("status"), F.lit("FRONTIER").alias("old_type"),
        F.when(page_id % 20 == 1, 404).cast("int").alias("old_status"),
    )


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"), F.col("ts").alias("time_added"),
        (F.col("event_type") == "error").alias("occupied"),
    )


def frontier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("site_id")
    )


def frontier_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    access = (
        F.when(user % 3 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(user % 2 == 0, ntz(OPENED)).otherwise(ntz(OPENS_LATER))
    )
    # Every eleventh site is not known yet.
    known = table(spark, sf_dir, "events").select(user).distinct().where(user % 11 != 5)
    return known.select(
        user.alias("id"), access.alias("next_acces"), (user % 7 + 1).cast("int").alias("delay")
    )
