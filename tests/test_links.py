import random
import time
from html.parser import HTMLParser

from conftest import plan_of, rows
from pyspark.sql import functions as F

from crawlmill.functions import html as H
from crawlmill.functions.references import decode_entities
from crawlmill.operators import links as L

PAGES = "page_id long, url string, html string"


def pages(spark, *bodies, head="", url="http://d.com/dir/p"):
    html = [f"<html><head>{head}</head><body>{b}</body></html>" for b in bodies]
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(html)], PAGES)


def found(spark, body, domains=(), **kw):
    df = L.extract_links(pages(spark, body, **kw), domains)
    return [(r["url"], r["cls"]) for r in df.orderBy("source", "pos").collect()]


def test_href_of_any_tag_in_order(spark):
    body = """<a href="/1">x</a><A class='c' HREF='/2'>x</A><area href=/3><link href = "/4">
              <p data-href="/no" title="a > b" href="/5">x</p><a href>root</a>"""
    assert [u for u, _ in found(spark, body)] == [
        f"http://d.com/{i}" for i in (1, 2, 3, 4, 5)
    ] + ["http://d.com/"]


def test_head_comments_and_scripts_are_skipped(spark):
    head = """<link href="/h1"><script>var a = "</head>";</script><!-- </head> --><a href="/h2">"""
    body = """<!-- <a href="/c"> --><script href="/s">"<a href='/t'>"</script>
              <style>a[href="/u"]{}</style><header><a href="/ok">x</a></header>"""
    assert [u for u, _ in found(spark, body, head=head)] == ["http://d.com/s", "http://d.com/ok"]


def test_what_is_not_closed_reaches_to_the_end(spark):
    assert found(spark, "<a href='/1'></a><!-- <a href='/2'>") == [("http://d.com/1", "page")]
    assert found(spark, "<a href='/1'></a><script><a href='/2'>") == [("http://d.com/1", "page")]
    unclosed = spark.createDataFrame([(1, "http://d.com/", "<head><body><a href='/x'></body>")], PAGES)
    assert L.extract_links(unclosed).count() == 0


def test_page_without_body_gives_nothing(spark):
    df = spark.createDataFrame(
        [(1, "http://d.com/", "<html><head><body></head><a href='/x'>"), (2, "http://d.com/", None),
         (3, "http://d.com/", "<BODY><a href='/x'>")], PAGES)
    assert rows(L.extract_links(df), "page_id", "url") == [(3, "http://d.com/x")]
    assert rows(L.page_bodies(df), "page_id") == [(3,)]


def test_entities_are_decoded_once(spark):
    body = '<a href="/a&amp;lt;b&#233;&#x10348;&quot;&#55296;">x</a>'
    raw = L.extract_links(pages(spark, body)).select("raw").first()[0]
    assert raw == '/a&lt;bé\U00010348"�'


def test_mail_and_other_schemes_are_no_links(spark):
    body = """<a href="i.n+f-o@bč.si"><a href="a@b.info"><a href="mailto:a@b.si"><a href="tel:1">
              <a href="javascript:x()">"""
    # Three letters are the longest ending the address pattern knows.
    assert found(spark, body) == [("http://d.com/a%40b.info", "page")]


def test_classes(spark):
    body = "".join(f'<a href="/f.{e}">' for e in (
        "pdf", "PDF", "Pdf", "pdfx", "doc", "DOCX", "ppt", "pptX", "pdf/", "mp4", "AVI", "Mp4",
        "mp3", "7z", "xls", "jpeg", "html", "TXT"))
    assert found(spark, body) == [
        ("http://d.com/f.pdf", "binary"), ("http://d.com/f.PDF", "binary"),
        ("http://d.com/f.pdfx", "binary"), ("http://d.com/f.doc", "binary"),
        ("http://d.com/f.DOCX", "binary"), ("http://d.com/f.ppt", "binary"),
        ("http://d.com/f.pptX", "binary"), ("http://d.com/f.pdf/", "binary"),
        ("http://d.com/f.Mp4", "page"), ("http://d.com/f.mp3", "page"),
        ("http://d.com/f.7z", "page"), ("http://d.com/f.html", "page"),
    ]


def test_onclick(spark):
    body = """<p onclick="location.href='/a'"><p onclick="window.location='/b.xls'">
              <p onclick="document.location.href='/c.pdf'"><p onclick="location.href = '/no'">
              <p onclick="parent.location='/d';"><p onclick="window.open('/no')">
              <p onclick="location='/e.mp4'">"""
    assert found(spark, body) == [
        ("http://d.com/a", "page"), ("http://d.com/b.xls", "page"),
        ("http://d.com/c.pdf", "binary"), ("http://d.com/d%3B", "page"),
        ("http://d.com/e.mp4", "page"),
    ]


def test_images_ignore_the_scope(spark):
    body = """<img src="/a.PNG"><img alt="x" src='http://o.net/b.jpeg'><img src=/c.Png><img src="/d.gif">
              <a href="http://o.net/x"><a href="http://in.d.com/y">"""
    assert found(spark, body, ["d.com"]) == [
        ("http://in.d.com/y", "page"), ("http://d.com/a.PNG", "image"),
        ("http://o.net/b.jpeg", "image"),
    ]


class _Collector(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs, self.onclicks, self.images = [], [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if "href" in attrs:
            self.hrefs.append(attrs["href"] or "")
        if "onclick" in attrs:
            self.onclicks.append(attrs["onclick"] or "")
        if tag == "img" and "src" in attrs:
            self.images.append(attrs["src"] or "")


def _random_markup(rng):
    def value():
        text = "".join(rng.choice("ab/.:?#=&;é '") for _ in range(rng.randint(0, 6)))
        text = text.replace("&", "&amp;")
        style = rng.random()
        if style < 0.5:
            return f'"{text}"' if '"' not in text else '""'
        if style < 0.8:
            return "'" + text.replace("'", "") + "'"
        return "x" + "".join(c for c in text if c not in " '=;&/")

    def tag():
        name = rng.choice(["a", "A", "img", "p", "area", "x-y", "link"])
        attrs = []
        for _ in range(rng.randint(0, 4)):
            key = rng.choice(["href", "HREF", "src", "onclick", "data-href", "hrefx", "alt", "disabled"])
            attrs.append(key if rng.random() < 0.1 else key + rng.choice(["=", " = ", "= "]) + value())
        gap = rng.choice([" ", "\n", "  "])
        return f"<{name}{gap if attrs else ''}{gap.join(attrs)}{rng.choice(['', ' ', ' /'])}>"

    parts = []
    for _ in range(rng.randint(1, 12)):
        kind = rng.random()
        if kind < 0.7:
            parts.append(tag())
        elif kind < 0.8:
            parts.append("<!-- " + tag() + " -->")
        elif kind < 0.9:
            parts.append("<script>" + tag() + "</script>")
        else:
            parts.append(rng.choice(["text", "a < b", "x > y", "</p>", "<br/>", "&amp;"]))
    return "<body>" + "".join(parts) + "</body>"


def test_extraction_agrees_with_a_parser_on_random_markup(spark):
    rng = random.Random(7)
    markup = [_random_markup(rng) for _ in range(1500)]
    df = spark.createDataFrame([(i, "http://d/", m) for i, m in enumerate(markup)], PAGES)
    keep = ("page_id",)
    raw = L.raw_links(L.link_arrays(df, keep), keep)
    got = {}
    for r in raw.orderBy("page_id", "source", "pos").collect():
        got.setdefault((r["page_id"], r["source"]), []).append(r["raw"])
    for i, text in enumerate(markup):
        parser = _Collector()
        parser.feed(text)
        parser.close()
        expected = (parser.hrefs, parser.onclicks, parser.images)
        assert tuple(got.get((i, s), []) for s in (1, 2, 3)) == expected, text


def test_long_pages_stay_linear(spark):
    big = [
        "<a " + "x=1 " * 200_000 + ">", "<p>" + " " * 1_000_000 + "x", "<" * 300_000,
        "<!-- " + "<a href='x'>" * 50_000, "<a href='" + "y" * 1_000_000 + "'>",
        "<a href=\"" * 30_000, "<script>" * 100_000, "<!--" * 200_000, "<head>" + "<!-" * 200_000,
        "<a " * 200_000, "<a x=" * 100_000, "<a x=y" * 100_000, "<img src" * 100_000, "<a href='' " * 100_000,
    ]
    df = pages(spark, *big)
    start = time.time()
    counts = L.link_arrays(df, ("page_id",)).select(F.size("hrefs")).collect()
    hashes = df.select(H.content_hash(F.col("html"))).collect()
    assert len(counts) == len(hashes) == len(big)
    assert time.time() - start < 60


def test_markup_is_cleaned_once_and_not_shuffled(spark, tmp_path):
    pages(spark, "<a href='/x'>").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    links = L.page_links(L.extract_links(df, ["d.com"])).where(F.length("url") < 3000)
    plan = plan_of(links)
    assert plan.count("regexp_replace(html") == 1
    assert "Exchange" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_references_are_read_once_as_the_standard_decoder_does(spark):
    import html
    import random
    from html.entities import html5

    rng = random.Random(1)
    names = list(html5)
    numbers = [0, 9, 12, 13, 38, 65, 128, 129, 150, 233, 55296, 64976, 65534, 1114111, 1114112, 10**20]
    pieces = ["&", "&&", "lt;", "#", "a", " ", "<", "é", "&#38;lt;", "&#x;", "&#;", "&nosuch;", "\n", "&" + "a" * 40, "&#x00000000000000041;", "&#XFFFFFFFFFFFFFFF", "&amplt;"]

    def piece():
        kind = rng.random()
        if kind < 0.3:
            return "&" + rng.choice(names)
        if kind < 0.4:
            return "&" + rng.choice(names).rstrip(";") + rng.choice(["", "x", "=1", ";"])
        if kind < 0.6:
            return f"&#{rng.choice(numbers)}{rng.choice(['', ';'])}"
        return f"&#x{rng.choice(numbers):x};" if kind < 0.8 else rng.choice(pieces)

    texts = ["".join(piece() for _ in range(rng.randint(0, 8))) for _ in range(1500)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", decode_entities(F.col("t")).alias("d")).collect():
        assert row.d == (None if row.t is None else html.unescape(row.t)), row.t
