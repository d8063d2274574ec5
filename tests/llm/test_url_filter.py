from collections import defaultdict

import duckdb
import pytest

from crawlmill.llm.catalog import URL_RULES
from crawlmill.llm.url_filter import DAMPING, ITERATIONS, Rule, judge_urls, oracle_sql

PAGES = [
    (1, "http://WWW.Example.com/en/1?x#y", "<a href='http://good.org/'>"),
    (2, "https://example.com/en/", None),
    (3, "https://example.com/e", ""),
    (4, "https://notexample.com/en/", "<A HREF = //Good.org/x>"),
    (5, "https://a.net/fr/?/es/", '<a href="https://evil.org/">'),
    (6, "https://bad.net/es/1", '<a href="https://bad.net/2">'),
    (7, "https://a.net/en/1", ""),
    (8, "https://good.org/1", '<a href="http://bystander.org"><a href="mailto:x"><a href="/rel">'),
    (9, "https://evil.org/1", '<a href="https://bad.net/es/"><a href="https://a.net/">'),
    (10, "https://linksevil.org#frag", '<a href="https://evil.org/x">'),
    (11, "https://bystander.org?q", None),
    (12, None, "<a href='http://bad.net/'>"),
    (13, "no scheme", ""),
    (14, "http:///path", ""),
    (15, "http://com", ""),
    (16, "http://sub.com/", ""),
    (16, "http://sub.com/", ""),
    (None, "http://x.net/es/" + "y" * 50000, "z" * 200000),
]


def brute(pages, rules):
    def parse(url):
        if not url or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        tail = rest[end:]
        stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
        return rest[:end].lower(), tail[:stop]

    def rule(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(str(r)), default=None)

    import re

    places = [parse(p[1]) for p in pages]
    ruled = [rule(*p) for p in places]
    edges, counts = set(), defaultdict(lambda: [0, 0, 0])
    for (host, _), r, page in zip(places, ruled, pages):
        if not host:
            continue
        counts[host][0] += 1
        if r:
            counts[host][1 + (r.verdict == "block")] += 1
        for target in re.findall(r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\s]+)""", page[2] or ""):
            if target.lower() != host:
                edges.add((host, target.lower()))
    score = {}
    for kind, place, pairs in (("t", 1, edges), ("d", 2, {(b, a) for a, b in edges})):
        seeds = {h for h, c in counts.items() if 2 * c[place] > c[0]}
        now = {h: 1 - DAMPING for h in seeds}
        for _ in range(ITERATIONS):
            new = defaultdict(float, {h: 1 - DAMPING for h in seeds})
            for a, b in sorted(pairs):
                new[b] += now.get(a, 0) * DAMPING / sum(1 for x, _ in pairs if x == a)
            now = new
        score[kind] = now
    out = []
    for (host, path), r, page in zip(places, ruled, pages):
        bad = score["d"].get(host, 0) > score["t"].get(host, 0) * (1 + 1e-9)
        out.append((page[0], host, path, str(r) if r else None, r.verdict if r else "block" if bad else "allow"))
    return sorted(out, key=str)


def test_verdicts_equal_brute_force_and_sql(spark):
    pages = spark.createDataFrame([(*p, "h", "r") for p in PAGES], "page_id long, url string, html string, host string, rule string")
    found = judge_urls(pages.repartition(3), URL_RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == brute(PAGES, URL_RULES)
    verdict = {r[0]: r[4] for r in rows}
    assert verdict[9] == verdict[10] == "block" and verdict[8] == verdict[11] == "allow"
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    assert sorted(duck.execute(oracle_sql(URL_RULES)).fetchall(), key=str) == rows


@pytest.mark.parametrize("rules", [[], [Rule("block", "org", "/")]])
def test_other_rules(spark, rules):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert sorted(map(tuple, judge_urls(pages, rules).collect()), key=str) == brute(PAGES, rules)


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), URL_RULES).collect() == []


def test_main_path_has_no_python(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    plan = judge_urls(pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
