"""No input may stop a job: random text goes through every expression that reads text."""

import random

from pyspark.sql import functions as F

from crawlmill.functions import html as H
from crawlmill.functions.references import decode_entities
from crawlmill.operators import links as L, robots as R

PIECES = [
    "%", "%2", "%zz", "%C3%A9", "%E9", "%00", "%25", "+", "/", "//", "..", ".", "?", "#", ";", ":",
    "http", "https://", "://", "@", "&", "&#", "&#0;", "&#99999999;", "&#xFFFFF;", "&#xD800;", "&#x;",
    "&amp;", "'", '"', "<", ">", "<a ", "href=", "<img src=", "onclick=", "location=", "<head>", "</head>",
    "<body>", "<!--", "-->", "<script>", "</script>", "<loc>", "</loc>", "\n", "\r\n", "\t", "\x00", "\x85",
    " ", "é", "漢", "\U0001f600", "User-agent:", "*", "Disallow:", "Allow:", "Crawl-delay:", "Sitemap: ",
    "9" * 12, "$1", "\\", "\\E", "(", "[", " ",
]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_pages(spark):
    df = spark.createDataFrame(
        [(i, t, t + "<body>" + t) for i, t in enumerate(texts(6000, 1))],
        "page_id long, url string, html string")
    links = L.extract_links(df, ["d.com"])
    assert links.count() == links.where(F.col("url").isNotNull()).count()
    links.select(F.max(F.length("url")), F.max("cls")).collect()
    raw = df.select(
        "page_id", F.col("url").alias("from_url"), F.lit("http").alias("scheme"), F.lit("d.com").alias("host"),
        F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("source"), F.lit(0).alias("pos"),
        decode_entities(F.col("url")).alias("raw"))
    urls = L.classified_links(raw)
    assert urls.where(~F.col("url").rlike(r"^https?://[^/]*/[A-Za-z0-9/._~%-]*$")).count() == 0
    df.select(H.content_hash(F.col("html")), H.has_body(F.col("html"))).distinct().count()


def test_robots_and_sitemaps(spark):
    df = spark.createDataFrame(
        [(f"d{i}", t, f"http://d{i}/{i % 7}%2F%E9") for i, t in enumerate(texts(6000, 2))],
        "domain string, robots_content string, url string")
    policies = R.robots_policies(df)
    assert R.robots_verdicts(df.select("domain", "url"), policies).count() == 6000
    maps = df.select("domain", F.col("robots_content").alias("sitemap_content"))
    R.sitemap_urls(maps, ["d1"]).select(F.max("url")).collect()
    df.select(R.sitemap_url(F.col("robots_content"))).distinct().count()
