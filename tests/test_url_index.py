from conftest import rows
from pyspark.sql import functions as F

from crawlmill.operators import url_index
from crawlmill.operators.url_index import UrlIndex, unseen_by_index


def urls(spark, *ranges):
    found = None
    for a, b in ranges:
        part = spark.range(a, b).select(F.concat(F.lit("http://d.si/"), F.col("id").cast("string")).alias("url"), "id")
        found = part if found is None else found.unionByName(part)
    return found


def test_result_is_exact_and_most_new_urls_are_cleared(spark):
    known, candidates = urls(spark, (0, 5000)), urls(spark, (4000, 9000))
    found = unseen_by_index(candidates, UrlIndex.of(known), known)
    assert sorted(r["id"] for r in found.rows.collect()) == list(range(5000, 9000))
    assert found.candidates == 5000 and 4000 * 0.9 < found.cleared <= 4000


def test_an_index_grows(spark):
    index = UrlIndex.of(urls(spark, (0, 100)), expected=4000).with_urls(urls(spark, (2000, 4000))).with_urls(urls(spark, (0, 50)))
    known = urls(spark, (0, 100), (2000, 4000))
    found = unseen_by_index(urls(spark, (0, 3000)), index, known)
    assert sorted(r["id"] for r in found.rows.collect()) == list(range(100, 2000)) and found.cleared > 1700


def test_beyond_its_bound_the_exact_join_decides(spark, monkeypatch):
    monkeypatch.setattr(url_index, "MOST_BITS", 1 << 15)
    known = urls(spark, (0, 20000))
    index = UrlIndex.of(known)
    assert index.slots == 1 << 15 and not index.is_useful()
    found = unseen_by_index(urls(spark, (19990, 20010)), index, known)
    assert sorted(r["id"] for r in found.rows.collect()) == list(range(20000, 20010)) and found.cleared == 0


def test_nulls_repeats_and_empty_tables(spark):
    candidates = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "url string")
    known = spark.createDataFrame([("b",), (None,)], "url string")
    assert rows(unseen_by_index(candidates, UrlIndex.of(known), known).rows) == [("a",), ("a",), (None,)]
    empty = known.limit(0)
    assert rows(unseen_by_index(candidates, UrlIndex.of(empty), empty).rows) == [("a",), ("a",), ("b",), (None,)]
    assert unseen_by_index(empty, UrlIndex.of(known), known).rows.collect() == []
