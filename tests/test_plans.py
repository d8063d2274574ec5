import random
from datetime import datetime

import pytest
from conftest import plan_of, rows
from model import crawl, levels
from pyspark.sql import functions as F

from crawlmill.plans.bfs import bfs_levels, next_level, split_edges
from crawlmill.plans.page_step import process_batch
from crawlmill.plans.replay import prepare_corpus, replay
from crawlmill.sources.writers import write_bucketed

AS_OF = datetime(2024, 1, 1)


def run_bfs(spark, seeds, edges, **kw):
    e = spark.createDataFrame(
        [(f, t, 1, i) for f, ts in edges.items() for i, t in enumerate(ts)],
        "from_url string, url string, source int, pos int")
    s = spark.createDataFrame(list(enumerate(seeds)), "seed_order long, url string")
    out = bfs_levels(e, s, **kw)
    return {r["url"]: (r["level"], r["from_url"]) for r in out.collect()}


def test_bfs_small_shapes(spark):
    edges = {"s": ["s", "b", "a"], "a": ["x", "s"], "b": ["x", "y"], "y": ["z"], "u": ["v"]}
    assert run_bfs(spark, ["s"], edges) == {
        "s": (0, None), "b": (1, "s"), "a": (1, "s"), "x": (2, "b"), "y": (2, "b"), "z": (3, "y")}
    assert set(run_bfs(spark, ["s"], edges, max_depth=1)) == {"s", "a", "b"}


def test_a_level_shuffles_neither_edges_nor_found_urls(spark, tmp_path):
    edges = spark.createDataFrame([(f"n{i}", f"n{(i * 7) % 50}", 1, i) for i in range(200)], "from_url string, url string, source int, pos int")
    found = spark.createDataFrame([(f"n{i}", None, i, i % 3) for i in range(30)], "url string, from_url string, seq long, level int")
    write_bucketed(edges, "plan_edges", "from_url", 4, str(tmp_path / "edges"))
    write_bucketed(found, "plan_found", "url", 4, str(tmp_path / "found"), "level")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = spark.table("plan_found")
        fresh = next_level(spark.table("plan_edges"), seen.where("level = 1"), seen, ("source", "pos"))
        plan = plan_of(fresh)
        assert fresh.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE plan_edges")
        spark.sql("DROP TABLE plan_found")
    # One shuffle: that of the links which the level leads to.
    assert plan.count("Exchange") == 1 and "hashpartitioning(url" in plan


def test_bfs_equals_a_queue_on_random_graphs(spark):
    rng = random.Random(3)
    for _ in range(3):
        nodes = [f"n{i}" for i in range(60)]
        edges = {n: [rng.choice(nodes) for _ in range(rng.randint(0, 3))] for n in nodes}
        seeds = rng.sample(nodes, 2)
        assert run_bfs(spark, seeds, edges) == levels(seeds, edges)


def test_a_level_is_one_file_for_a_bucket(spark, tmp_path):
    rows = spark.createDataFrame([(f"n{i}", i % 2) for i in range(400)], "url string, level int").repartition(6)
    try:
        for level in (0, 1):
            write_bucketed(rows.where(f"level = {level}"), "bucket_files", "url", 3, str(tmp_path / "found"), "level")
        assert len(list(tmp_path.rglob("*.parquet"))) == 6
        assert spark.table("bucket_files").count() == 400
    finally:
        spark.sql("DROP TABLE IF EXISTS bucket_files")


def test_links_that_lead_no_further_are_not_searched_level_by_level(spark):
    edges = spark.createDataFrame(
        [("s", "a", 1), ("s", "x", 2), ("a", "x", 1), ("a", "y", 2), ("b", "s", 1), ("q", "z", 1), (None, "n", 1)],
        "from_url string, url string, pos int")
    inner, leaves = split_edges(edges)
    assert set(rows(inner.select("from_url", "url"))) == {("s", "a"), ("b", "s")}
    assert leaves.count() == 5
    seeds = spark.createDataFrame([("s", 0), ("x", 1), (None, 2)], "url string, seed_order int")
    found = bfs_levels(edges, seeds, ("pos",), buckets=2)
    assert set(rows(found.select("url", "level", "from_url"))) == {("s", 0, None), ("x", 0, None), (None, 0, None), ("a", 1, "s"), ("y", 2, "a")}
    ordered = [r.url for r in found.orderBy("seq").collect()]
    assert ordered == ["s", "x", None, "a", "y"]


def random_web(rng):
    hosts = [f"h{i}.si" for i in range(5)]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['a', 'b', 'c'])}/{i}" for i in range(70)]
    corpus = {}
    for url in urls[:60]:  # the others are linked to but give no response
        status = rng.choice([200, 200, 200, 200, 404, 500, None])
        links = [rng.choice(urls) for _ in range(rng.randint(0, 4))]
        copy = rng.random() < 0.3
        body = "copied %d" % rng.randint(0, 2) if copy else "own " + url
        if copy:
            links = []
        content = None if rng.random() < 0.1 else body + "".join(links)
        corpus[url] = (status, content, links if content is not None else [])
    sites = {}
    for host in hosts[:4]:
        letter = rng.choice("abc")
        forbidden = {u for u in urls if u.startswith(f"http://{host}/{letter}/")}
        located = [u for u in rng.sample(urls, 6)]
        sites[host] = (letter, forbidden, located)
    return urls, corpus, sites


def replay_of(spark, seeds, corpus, sites, **kw):
    def html(content, links):
        if content is None:
            return "<html>nothing</html>"
        anchors = "".join(f"<a href='{u}'>x</a>" for u in links)
        return f"<html><head>{id(links)}</head><body>{content}{anchors}</body></html>"

    pages = spark.createDataFrame(
        [(i, u, html(c, ls), s) for i, (u, (s, c, ls)) in enumerate(corpus.items())],
        "page_id long, url string, html string, status int")
    site_rows = spark.createDataFrame(
        [(h, f"User-agent: *\nDisallow: /{letter}/", "".join(f"<loc>{u}</loc>" for u in located))
         for h, (letter, _, located) in sites.items()],
        "domain string, robots_content string, sitemap_content string")
    seed_rows = spark.createDataFrame(list(enumerate(seeds)), "seed_order long, url string")
    return replay(prepare_corpus(pages, site_rows), seed_rows, **kw)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_one_url_at_a_time(spark, seed):
    rng = random.Random(seed)
    urls, corpus, sites = random_web(rng)
    seeds = rng.sample(urls, 3)
    result = replay_of(spark, seeds, corpus, sites)
    pages, links = crawl(seeds, corpus, {h: (f, m) for h, (_, f, m) in sites.items()})
    got = {r["url"]: (r["page_type_code"], r["http_status_code"]) for r in result.pages.collect()}
    assert got == pages
    assert set(rows(result.links, "from_url", "to_url")) == links
    assert result.frontier.count() == 0
    # invariants: one row per URL, at most one discovery link into a page, links between pages
    assert result.pages.count() == result.pages.select("url").distinct().count()
    assert result.links.count() == result.links.select("to_url").distinct().count()


def test_replay_with_retries(spark):
    corpus = {
        "http://h.si/": (200, "x", ["http://h.si/e", "http://h.si/gone", "http://h.si/y"]),
        "http://h.si/e": (404, None, []),
        "http://h.si/y": (200, "y", []),
    }
    once = replay_of(spark, ["http://h.si/"], corpus, {"x.si": ("q", set(), [])})
    assert dict(rows(once.pages, "url", "page_type_code"))["http://h.si/e"] == "FRONTIER"
    tried = replay_of(
        spark, ["http://h.si/"], corpus, {"x.si": ("q", set(), [])}, final_dequeue=False, max_rounds=5)
    assert rows(tried.pages, "url", "page_type_code", "http_status_code") == [
        ("http://h.si/", "HTML", 200), ("http://h.si/e", "HTML", 404),
        ("http://h.si/gone", "FRONTIER", None), ("http://h.si/y", "HTML", 200)]
    assert rows(tried.frontier) == [("http://h.si/gone",)]
    with pytest.raises(ValueError):
        replay_of(spark, ["http://h.si/"], corpus, {"x.si": ("q", set(), [])}, final_dequeue=False)


def test_process_batch(spark):
    def html(body, head=""):
        return f"<html><head>{head}</head><body>{body}</body></html>"

    batch = spark.createDataFrame([
        (1, "http://d.si/1", html("<a href='/2'>x</a><a href='/n'>x</a><a href='/f.pdf'>x</a>"), 200, None),
        (2, "http://d.si/2", html("<a href='/2'>x</a> <a href='/n'>x</a><a href='/f.pdf'>x</a>", "t"), 200, None),
        (3, "http://d.si/3", html("<a href='/m'>x</a>"), 404, None),
        (4, "http://d.si/4", html("<a href='/m'>x</a>"), 404, 500),
        (5, "http://d.si/5", None, None, None),
        (6, "http://d.si/6", "<html>no</html>", 200, None),
        (7, "http://d.si/7", html("<a href='http://e.si/o'>x</a><a href='/n'>x</a>"), 200, 404),
    ], "page_id long, url string, html string, status int, old_status int").withColumn("old_type", F.lit("FRONTIER"))
    sites = spark.createDataFrame([("d.si",)], "domain string")
    out = process_batch(batch, batch, sites, None, AS_OF, ["d.si", "e.si"])
    assert rows(out.pages, "page_id", "page_type_code", "http_status_code", "requeue", "store_content") == [
        (1, "HTML", 200, False, True), (2, "DUPLICATE", 200, False, False),
        (3, "FRONTIER", 404, True, False), (4, "HTML", 404, False, False),
        (5, "FRONTIER", None, True, False), (6, "HTML", 200, False, False), (7, "HTML", 200, False, True)]
    assert rows(out.discovery.new_links()) == [
        ("http://d.si/1", "http://d.si/n"), ("http://d.si/7", "http://e.si/o")]
    assert rows(out.discovery.new_sites()) == [("e.si",)]
    assert rows(out.documents, "page_id", "data_type_code") == [(1, "PDF")]
    assert rows(out.contents()) == [
        (1, "<html><body><a href='/2'>x</a><a href='/n'>x</a><a href='/f.pdf'>x</a></body></html>"),
        (7, "<html><body><a href='http://e.si/o'>x</a><a href='/n'>x</a></body></html>")]
    assert rows(out.frontier_removed(), "page_id") == [(1,), (2,), (4,), (6,), (7,)]
