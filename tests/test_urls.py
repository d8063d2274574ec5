import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from crawlmill.functions.urls import (
    in_scope, path_of, percent_decode, percent_encode, site_of, with_canonical_url,
)

CASES = [
    # url, parent scheme, parent host, expected
    ("http://some.domain.com", "", "", "http://some.domain.com/"),
    ("http://domain.com:80/path#there", "", "", "http://domain.com/path"),
    ("http://domain.com/test/./../end", "", "", "http://domain.com/end"),
    ("/relative/path", "http", "domain.com", "http://domain.com/relative/path"),
    ("http://domain.com/s pace.php", "", "", "http://domain.com/s%20pace.php"),
    ("http://domain.com/s%20pace.php", "", "", "http://domain.com/s%20pace.php"),
    ("http://domain.com/index.html", "", "", "http://domain.com/"),
    ("a/b", "http", "d.com", "http://d.com/a/b"),
    ("", "http", "d.com", "http://d.com/"),
    ("#x", "http", "d.com", "http://d.com/"),
    ("?q=1", "http", "d.com", "http://d.com/"),
    ("/p?q=1#f", "http", "d.com", "http://d.com/p"),
    ("mailto:a@b.si", "http", "d.com", None),
    ("javascript:void(0)", "http", "d.com", None),
    ("tel:123", "http", "d.com", None),
    ("ftp://d.com/x", "http", "d.com", None),
    ("//c.com/x", "https", "d.com", "https://c.com/x"),
    ("HTTP://D.com/X", "", "", "http://d.com/X"),
    ("https://d.com:443/x", "", "", "https://d.com/x"),
    ("http://d.com:443/x", "", "", "http://d.com:443/x"),
    ("http://d.com:8080/x", "", "", "http://d.com:8080/x"),
    ("/index.htmlx", "http", "d.com", "http://d.com/x"),
    ("/x/index.php5", "http", "d.com", "http://d.com/x/5"),
    ("/x/INDEX.html", "http", "d.com", "http://d.com/x/INDEX.html"),
    ("/a//b/", "http", "d.com", "http://d.com/a/b/"),
    ("/a/..", "http", "d.com", "http://d.com/"),
    ("/../../a", "http", "d.com", "http://d.com/a"),
    ("/a/.hidden", "http", "d.com", "http://d.com/a/.hidden"),
    ("/a/%2e%2e/b", "http", "d.com", "http://d.com/b"),
    ("/é/%C3%A9/%c3%a9", "http", "d.com", "http://d.com/%C3%A9/%C3%A9/%C3%A9"),
    ("/100%/x", "http", "d.com", "http://d.com/100%25/x"),
    ("/a%2fb", "http", "d.com", "http://d.com/a%2Fb"),
    ("/%E9/ü", "http", "d.com", "http://d.com/%E9/%C3%BC"),
    ("/a+b*~", "http", "d.com", "http://d.com/a%2Bb%2A~"),
    (None, "http", "d.com", None),
]


def canonical(spark, cases, domains=()):
    df = spark.createDataFrame(
        [(i, *c[:3]) for i, c in enumerate(cases)],
        "i int, raw string, scheme string, host string",
    )
    out = with_canonical_url(df, "raw", "scheme", "host", domains)
    return [r["url"] for r in out.orderBy("i").collect()]


def test_canonical_urls(spark):
    assert canonical(spark, CASES) == [c[3] for c in CASES]


def test_canonical_form_is_stable(spark):
    urls = [(u, "", "") for u in canonical(spark, CASES) if u]
    assert canonical(spark, urls) == [u[0] for u in urls]


SEGMENT = st.text(
    alphabet=st.sampled_from(list("ab.%/2fF5eE9 +*~éü漢;,:@&=$!'()")), max_size=12
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(paths=st.lists(SEGMENT, min_size=200, max_size=200))
def test_canonical_form_is_stable_for_any_path(spark, paths):
    once = canonical(spark, [("/" + p, "http", "d.com") for p in paths])
    again = canonical(spark, [(u, "", "") for u in once])
    assert again == once


def test_scope_is_a_loose_suffix(spark):
    hosts = ["portal.gov.si", "www.portal.gov.si", "notportal.gov.si", "portal-gov.si",
             "portal.gov.si:80", "gov.si", "EVEM.gov.si", "portal.gov.si/"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    found = {r[0]: r[1] for r in df.select("h", in_scope(F.col("h"), ["portal.gov.si", "x.si"])).collect()}
    assert [h for h in hosts if found[h]] == [
        "portal.gov.si", "www.portal.gov.si", "notportal.gov.si", "portal-gov.si", "portal.gov.si/"
    ]
    assert all(r[0] for r in df.select(in_scope(F.col("h"), [])).collect())
    with pytest.raises(TypeError):
        in_scope(F.col("h"), "portal.gov.si")


def test_out_of_scope_url_is_null(spark):
    assert canonical(spark, [("http://bad.domain/", "", "")], ["domain.com"]) == [None]
    assert canonical(spark, [("http://www.domain.com/", "", "")], ["domain.com"]) == [
        "http://www.domain.com/"
    ]
    # The host is tested as written, so a port hides the suffix.
    assert canonical(spark, [("http://domain.com:80/", "", "")], ["domain.com"]) == [None]


def test_parts_of_canonical_urls(spark):
    df = spark.createDataFrame([("http://a.b:8080/c/d",), ("http://a.b/",)], "u string")
    assert rows(df.select(site_of(F.col("u")), path_of(F.col("u")))) == [
        ("a.b", "/"), ("a.b:8080", "/c/d")
    ]


def test_percent_coding_follows_the_standard_library(spark):
    from urllib.parse import quote, unquote

    texts = ["a b", "a+b", "%41%zz%", "é/漢~*", "100%", "%25", "a%2Fb", "(x)'!;:@&=,$"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(percent_decode(F.col("t")), percent_encode(F.col("t"))).orderBy("i").collect()
    assert [r[0] for r in got] == [unquote(t) for t in texts]
    assert [r[1] for r in got] == [quote(t, safe="") for t in texts]
