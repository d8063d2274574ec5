import random
import time
from datetime import datetime
from urllib.robotparser import RobotFileParser

from conftest import plan_of, rows
from pyspark.sql import functions as F

from crawlmill.operators import robots as R
from crawlmill.session import materialize

SITES = "domain string, robots_content string"


def rules_of(spark, text):
    df = spark.createDataFrame([("d", text)], SITES)
    return [(r["allow"], r["prefix"]) for r in R.robots_rules(df).orderBy("pos").collect()]


def delay_of(spark, text):
    df = spark.createDataFrame([("d", text)], SITES)
    return tuple(R.robots_policies(df).select("crawl_delay", "delay").first())


def test_rules(spark):
    assert rules_of(spark, None) == []
    assert rules_of(spark, "") == []
    assert rules_of(spark, "User-agent: *\nAllow: /a\nDisallow: /") == [(True, "/a"), (False, "/")]
    assert rules_of(spark, "User-agent: *\r\nDisallow: /a\r\n") == [(False, "/a")]
    assert rules_of(spark, "User-agent: *\nDisallow:") == [(True, "")]
    assert rules_of(spark, "User-agent: *\nDisallow: *") == [(False, "%2A")]
    assert rules_of(spark, "User-agent: *\n\nDisallow: /a") == []
    assert rules_of(spark, "User-agent: *\n \nDisallow: /a") == [(False, "/a")]
    assert rules_of(spark, "User-agent: *\n# note\nDisallow: /a # x") == [(False, "/a")]
    two = "User-agent: *\nDisallow: /1\n\nUser-agent: *\nDisallow: /2"
    assert rules_of(spark, two) == [(False, "/1")]
    unnamed = "User-agent: *\nDisallow: /1\n\nUser-agent:\nDisallow: /2"
    assert rules_of(spark, unnamed) == [(False, "/2")]
    # A sitemap line without a blank does not cost the rules.
    assert rules_of(spark, "User-agent: *\nDisallow: /a\nSitemap:http://x") == [(False, "/a")]


def test_delays(spark):
    assert delay_of(spark, None) == (None, 4)
    assert delay_of(spark, "User-agent: *\nDisallow: /") == (None, 4)
    assert delay_of(spark, "User-agent: *\nCrawl-delay: 0") == (0, 4)
    assert delay_of(spark, "User-agent: *\nCrawl-delay: 0.5") == (None, 4)
    assert delay_of(spark, "User-agent: *\nCrawl-delay: 7") == (7, 7)
    assert delay_of(spark, "User-agent: *\nCrawl-delay: 86400") == (86400, 86400)
    assert delay_of(spark, "User-agent: *\nCrawl-delay: " + "9" * 30) == (2**31 - 1, 2**31 - 1)
    assert delay_of(spark, "User-agent: *\nCrawl-delay: 7\nCrawl-delay: 9\nCrawl-delay: x") == (9, 9)


def _random_file(rng):
    # No path starts with an encoded slash: what "//" means there differs between versions
    # of the standard library.
    def path():
        return rng.choice(["", "/", "/a", "/a/b", "/%61", "/é", "/a b", "*", "/a?x=1", "/a;", "/b?", "/c#",
                           "/a*", "/a%2Fx", "/a%zz", "a", "/~x", "/%7Ex"])

    lines = []
    for _ in range(rng.randint(0, 14)):
        kind = rng.random()
        if kind < 0.3:
            lines.append(rng.choice(["User-agent", "user-AGENT ", " User-agent"]) + ":" + rng.choice(
                [" *", "*", "", " bot", " *bot", " %2A"]))
        elif kind < 0.65:
            lines.append(rng.choice(["Allow", "Disallow", "disallow"]) + rng.choice([": ", ":", " : "]) + path())
        elif kind < 0.75:
            lines.append("Crawl-delay: " + rng.choice(["1", "0", "12", "x", "1.5", ""]))
        elif kind < 0.8:
            lines.append("Request-rate: 1/5")
        elif kind < 0.9:
            lines.append(rng.choice(["", "", " ", "# c", "\t"]))
        else:
            lines.append(rng.choice(["Sitemap: http://x/y", "nonsense", "Host: x", "Allow"]))
        if rng.random() < 0.1:
            lines[-1] += " # comment"
    return rng.choice(["\n", "\r\n", "\r"]).join(lines)


def test_verdicts_and_delays_agree_with_the_standard_library(spark):
    rng = random.Random(11)
    files = {f"d{i}.com": _random_file(rng) for i in range(1200)}
    paths = ["/", "/a", "/a/b/c", "/b", "/%C3%A9/x", "/a%20b", "/%2A", "/~x", "/c", "/a%3Fx%3D1", "/a%2Fx", "/x"]
    sites = spark.createDataFrame(list(files.items()), SITES)
    urls = sites.select("domain", F.explode(F.array(*[F.lit(p) for p in paths])).alias("p")).select(
        "domain", F.concat(F.lit("http://"), "domain", "p").alias("url"))
    policies = R.robots_policies(sites).cache()
    allowed = {r["url"]: r["allowed"] for r in R.robots_verdicts(urls, policies).collect()}
    delays = {r["domain"]: r["delay"] for r in policies.collect()}
    for domain, text in files.items():
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        assert delays[domain] == (parser.crawl_delay("*") or 4), text
        for p in paths:
            url = f"http://{domain}{p}"
            assert allowed[url] == parser.can_fetch("*", url), (text, p)


def test_verdict_join_has_no_nested_loop(spark):
    sites = spark.createDataFrame([("d", "User-agent: *\nDisallow: /x")], SITES)
    urls = spark.createDataFrame([("http://d/x", "d"), ("http://e/x", "e")], "url string, domain string")
    verdicts = R.robots_verdicts(urls, R.robots_policies(sites))
    assert "NestedLoop" not in plan_of(verdicts) and "Cartesian" not in plan_of(verdicts)
    assert rows(verdicts, "url", "allowed", "delay") == [("http://d/x", False, 4), ("http://e/x", True, 4)]


AS_OF = datetime(2024, 1, 1, 12)
STATES = [
    # domain, robots, next access, delay, expected decision for /ok and /no
    ("first.si", None, None, None, "FETCH", "FORBIDDEN"),
    ("early.si", "User-agent: *\nDisallow: /no", datetime(2024, 1, 1, 13), 5, "DELAY", "FORBIDDEN"),
    ("now.si", "User-agent: *\nDisallow: /no", AS_OF, 5, "FETCH", "FORBIDDEN"),
    ("late.si", "User-agent: *\nDisallow: /no", datetime(2024, 1, 1, 11), 5, "FETCH", "FORBIDDEN"),
    ("empty.si", "", datetime(2024, 1, 1, 13), 4, "DELAY", "DELAY"),
]


def site_rows(spark):
    return spark.createDataFrame(
        [(i, s[0], s[1], None, s[2], s[3]) for i, s in enumerate(STATES)],
        "id long, domain string, robots_content string, sitemap_content string, "
        "next_acces timestamp_ntz, delay short",
    )


def fetched(spark):
    return spark.createDataFrame(
        [("first.si", "User-agent: *\nDisallow: /no\nCrawl-delay: 6", "<loc>/s</loc>")],
        "domain string, robots_content string, sitemap_content string",
    )


def test_decisions_and_site_update(spark):
    sites = site_rows(spark)
    current = R.with_current_robots(sites, fetched(spark))
    assert rows(current.where("first_visit"), "domain", "sitemap_content") == [("first.si", "<loc>/s</loc>")]
    states = R.site_states(current)
    urls = sites.select("domain", F.explode(F.array(F.lit("/ok"), F.lit("/no"))).alias("p")).select(
        "domain", F.concat(F.lit("http://"), "domain", "p").alias("url"))
    decisions = R.fetch_decisions(urls, states, AS_OF)
    expected = sorted(
        (f"http://{s[0]}/{p}", s[4 if p == "ok" else 5]) for s in STATES for p in ("ok", "no"))
    assert rows(decisions, "url", "decision") == expected

    only_forbidden = decisions.where("url like '%/no'")
    update = dict((r[0], r[1:]) for r in rows(R.site_update(only_forbidden, AS_OF)))
    assert update["first.si"] == (datetime(2024, 1, 1, 12, 0, 6), 6)  # moves although forbidden
    assert update["now.si"] == (AS_OF, 5)
    every = dict((r[0], r[1:]) for r in rows(R.site_update(decisions, AS_OF)))
    assert every["now.si"] == (datetime(2024, 1, 1, 12, 0, 5), 5)
    assert every["early.si"] == (datetime(2024, 1, 1, 13), 5)


def test_sitemap_url(spark):
    texts = ["Sitemap: http://a/1 \r\nSitemap: http://a/2", "sitemap: http://a/1", "Sitemap:http://a/1", None,
             "Sitemap: "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(R.sitemap_url(F.col("t"))).collect()] == [
        "http://a/1", None, None, None, None]


def test_sitemap_pages(spark):
    xml = ("<urlset><url><loc>http://d.si/a?x=1&amp;y=2</loc></url><URL><LOC attr='1'>/b</LOC>"
           "<loc><![CDATA[http://d.si/c]]></loc><loc>http://other.net/x</loc><loc>http://e.d.si/e</loc>"
           "<loc>http://d.si/known</loc><loc>http://d.si/a</loc><image:loc>/i</image:loc><loc>broken")
    maps = spark.createDataFrame([("d.si", xml)], "domain string, sitemap_content string")
    assert [r["loc"] for r in R.sitemap_locs(maps).orderBy("pos").collect()] == [
        "http://d.si/a?x=1&y=2", "/b", "http://d.si/c", "http://other.net/x", "http://e.d.si/e",
        "http://d.si/known", "http://d.si/a"]
    known = spark.createDataFrame([("http://d.si/known",)], "url string")
    found = R.sitemap_frontier(maps, known, AS_OF, ["d.si"])
    assert rows(found, "url", "site_domain", "url_host", "accessed_time") == [
        ("http://d.si/a", "d.si", "d.si", AS_OF), ("http://d.si/b", "d.si", "d.si", AS_OF),
        ("http://d.si/c", "d.si", "d.si", AS_OF), ("http://e.d.si/e", "d.si", "e.d.si", AS_OF)]


def test_sitemap_index_is_read_like_a_sitemap(spark):
    xml = "<sitemapindex><sitemap><loc>http://d.si/s1.xml</loc></sitemap></sitemapindex>"
    maps = spark.createDataFrame([("d.si", xml)], "domain string, sitemap_content string")
    assert rows(R.sitemap_urls(maps), "url") == [("http://d.si/s1.xml",)]


def test_long_files_stay_linear(spark):
    start = time.time()
    texts = ["User-agent: x\n" * 50_000, "User-agent: *\n" + "Disallow: /a;b/\n" * 50_000,
             "User-agent: *\nDisallow: /" + "x/" * 100_000, "a" * 1_000_000, "User-agent: *\nDisallow: /" + ";" * 50_000]
    sites = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], SITES)
    sizes = R.robots_policies(sites).select("domain", F.size("rules"))
    assert rows(sizes) == [("0", 0), ("1", 50_000), ("2", 1), ("3", 0), ("4", 1)]
    maps = spark.createDataFrame(
        [("d", "<loc>" * 200_000), ("e", "<loc>x" + "<" * 500_000), ("f", "<loc>/x</loc>" * 20_000)],
        "domain string, sitemap_content string")
    assert R.sitemap_locs(maps).count() == 20_000
    assert time.time() - start < 60


def test_only_good_sitemap_responses_count(spark):
    df = spark.createDataFrame([("a", 200), ("b", 404), ("c", None)], "domain string, status int")
    assert rows(R.accepted_sitemaps(df), "domain") == [("a",)]


def test_a_site_of_many_rules_is_asked_by_prefix(spark):
    draw = random.Random(4)
    parts = ["a", "b", "c", "/", "d/", "1", "%C3%A9"]
    prefix = lambda: "/" + "".join(draw.choice(parts) for _ in range(draw.randrange(0, 7)))
    text = "User-agent: *\n" + "".join(f"{draw.choice(['Allow', 'Disallow'])}: {prefix()}\n" for _ in range(10_000)) + "Disallow: \n"
    few = "User-agent: *\nDisallow: /a\n"
    sites = spark.createDataFrame([("long.si", text), ("short.si", few), ("none.si", "")], "domain string, robots_content string")
    urls = [(i, f"http://{d}{prefix()}", d) for i, d in enumerate(["long.si", "short.si", "none.si", "unknown.si"] * 150)]
    urls += [(900, "http://long.si/", "long.si"), (901, "http://long.si/" + "a" * 2000, "long.si"), (902, "http://long.si/zzz", "long.si")]
    frame = spark.createDataFrame(urls, "page_id long, url string, domain string")
    policies = materialize(R.robots_policies(sites), "policies")
    by_prefix = rows(R.robots_verdicts(frame, policies), "page_id", "allowed", "delay")
    assert by_prefix == rows(R.robots_verdicts(frame, policies, many=1 << 30), "page_id", "allowed", "delay")
    assert by_prefix == rows(R.robots_verdicts(frame, policies, many=0), "page_id", "allowed", "delay")
    assert len(by_prefix) == len(urls) and {a for _, a, _ in by_prefix} == {True, False}
