"""Whole crawls through the table versions, with a dictionary in place of the network."""

import random
from datetime import datetime, timedelta

from conftest import rows
from model import crawl
from pyspark.sql import functions as F

from crawlmill.operators.tables import fk_violations
from crawlmill.plans.crawl_db import CrawlDb
from crawlmill.sources.readers import seed_urls

T0 = datetime(2024, 1, 1)


def html(content, links):
    return "<html><head></head><body>%s%s</body></html>" % (
        content, "".join(f"<a href='{u}'>x</a>" for u in links))


def fetch(spark, listed, corpus):
    out = []
    for r in listed.collect():
        status, content, links = corpus.get(r["url"], (None, None, []))
        body = html(content, links) if status == 200 and content is not None else "<html></html>"
        out.append((r["page_id"], r["url"], r["old_type"], r["old_status"], status, body))
    return spark.createDataFrame(
        out, "page_id long, url string, old_type string, old_status int, status int, html string")


def robots_for(spark, domains, sites):
    out = []
    for r in domains.collect():
        letter, located = sites.get(r["domain"], (None, []))
        text = f"User-agent: *\nDisallow: /{letter}/\nCrawl-delay: 2" if letter else None
        out.append((r["domain"], text, "".join(f"<loc>{u}</loc>" for u in located) or None))
    return spark.createDataFrame(out, "domain string, robots_content string, sitemap_content string")


def run(spark, root, seeds, corpus, sites, per_site, limit=60):
    db = CrawlDb.create(spark, root).start(seed_urls(spark, seeds), T0)
    now = T0
    for _ in range(limit):
        if db.table("frontier").isEmpty():
            break
        db, listed = db.select(now, per_site, robots_for(spark, db.new_domains(now), sites))
        db = db.apply(fetch(spark, listed, corpus), now)
        now += timedelta(seconds=10)
    return db


def test_single_site_crawl_equals_the_model(spark, tmp_path):
    rng = random.Random(5)
    urls = [f"http://h.si/{rng.choice('abc')}/{i}" for i in range(10)]
    corpus = {
        u: (rng.choice([200, 200, 200, 404, None]), rng.choice(["same", u, u]),
            [rng.choice(urls) for _ in range(3)]) for u in urls[:9]}
    for u, (s, c, ls) in list(corpus.items()):
        if c == "same":
            corpus[u] = (s, c, [])
    sites = {"h.si": ("b", urls[4:7])}
    seeds = urls[:2]
    db = run(spark, str(tmp_path), seeds, corpus, sites, per_site=3)
    forbidden = {u for u in urls if "/b/" in u}
    pages, links = crawl(seeds, corpus, {"h.si": (forbidden, urls[4:7])})
    page = db.table("page")
    got = {r["url"]: (r["page_type_code"], r["http_status_code"]) for r in page.collect()}
    assert {u: s for u, s in got.items()} == pages
    named = {r["id"]: r["url"] for r in page.collect()}
    assert {(named[f], named[t]) for f, t in rows(db.table("link"))} == links
    assert db.table("frontier").count() == 0
    assert rows(page.select("id")) == sorted(((i,) for i in range(1, len(pages) + 1)), key=str)
    stored = page.where(F.col("content_hash").isNotNull()).select("id")
    assert rows(db.pages_with_content().where("html_content is not null"), "id") == rows(stored)


def test_several_sites_keep_the_constraints(spark, tmp_path):
    corpus = {
        "http://a.si/": (200, "a", ["http://b.si/x", "http://a.si/f.pdf", "/i"]),
        "http://b.si/x": (200, "b", ["http://a.si/", "http://c.si/"]),
    }
    db = run(spark, str(tmp_path), ["http://a.si/", "http://a.si/"], corpus, {"b.si": ("q", [])}, 1)
    assert rows(db.table("site"), "id", "domain", "delay") == [(1, "a.si", 4), (2, "b.si", 2), (3, "c.si", 4)]
    assert rows(db.table("page"), "url", "page_type_code", "site_id") == [
        ("http://a.si/", "HTML", 1), ("http://a.si/i", "FRONTIER", 1),
        ("http://b.si/x", "HTML", 2), ("http://c.si/", "FRONTIER", 3)]
    assert rows(db.table("page_data"), "page_id", "data_type_code") == [(1, "PDF")]
    tables = {n: db.table(n) for n in ("site", "page", "frontier", "link", "page_data", "image")}
    assert fk_violations(tables).count() == 0


def test_politeness_and_restart(spark, tmp_path):
    seeds = [f"http://a.si/{i}" for i in range(4)]
    corpus = {u: (200, u, []) for u in seeds}
    db = CrawlDb.create(spark, str(tmp_path)).start(seed_urls(spark, seeds), T0)
    db, listed = db.select(T0, 3, robots_for(spark, db.new_domains(T0), {"a.si": ("q", [])}))
    assert rows(listed, "url", "fetch_time") == [
        (seeds[0], T0), (seeds[1], T0 + timedelta(seconds=2)), (seeds[2], T0 + timedelta(seconds=4))]
    assert rows(db.table("site"), "next_acces") == [(T0 + timedelta(seconds=6),)]
    early = T0 + timedelta(seconds=5)
    assert db.select(early)[1].count() == 0  # the site is not open yet
    assert db.table("frontier").where("occupied").count() == 3
    # A start after a crash frees the rows and adds no seeds.
    again = db.start(seed_urls(spark, seeds), early)
    assert again.table("frontier").where("occupied").count() == 0
    assert again.table("page").count() == 4
    # A version is not touched by later ones.
    done = db.apply(fetch(spark, listed, corpus), early)
    assert done.table("frontier").count() == 1 and db.table("frontier").count() == 4


def test_the_last_version_can_be_opened_again(spark, tmp_path):
    seeds = ["http://a.si/", "http://b.si/"]
    corpus = {u: (200, u, [u + "x"]) for u in seeds}
    db = CrawlDb.create(spark, str(tmp_path)).start(seed_urls(spark, seeds), T0)
    db, listed = db.select(T0)
    db = db.apply(fetch(spark, listed, corpus), T0)
    again = CrawlDb.open(spark, str(tmp_path))
    assert again == db
    assert rows(again.table("page")) == rows(db.table("page"))
    assert again.table("link").count() == 2
