from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from crawlmill import constants as C
from crawlmill.limits import COLUMN_LIMITS
from crawlmill.operators import assets, reports, tables as T, transitions
from crawlmill.operators.store import stage_files
from crawlmill.sources import readers, writers

AS_OF = datetime(2024, 1, 1)


def test_page_state(spark):
    df = spark.createDataFrame([(s,) for s in (200, 301, 399, 400, 500, None)], "status int")
    got = [r[0] for r in df.select(transitions.page_state(F.col("status"))).collect()]
    assert got == ["ok", "ok", "ok", "error", "error", None]


@pytest.mark.parametrize("final", [False, True])
def test_transitions(spark, final):
    cases = [
        # old status, status, has_body, is_dup -> type, status, requeue, store
        (None, 404, None, None, "FRONTIER", 404, True, False),
        (404, 500, None, None, "HTML", 500, False, False),
        (None, None, None, None, "FRONTIER", None, True, False),
        (404, None, None, None, "FRONTIER", 404, True, False),
        (None, 200, False, False, "HTML", 200, False, False),
        (None, 200, True, True, "DUPLICATE", 200, False, False),
        (404, 200, True, False, "HTML", 200, False, True),
    ]
    df = spark.createDataFrame(
        [(i, "FRONTIER", *c[:4]) for i, c in enumerate(cases)],
        "i int, old_type string, old_status int, status int, has_body boolean, is_dup boolean")
    out = transitions.page_transitions(df, final).orderBy("i").select(
        "page_type_code", "http_status_code", "requeue", "store_content").collect()
    expected = [(c[4], c[5], c[6] and not final, c[7]) for c in cases]
    assert [tuple(r) for r in out] == expected


def test_updates_take_nulls_too(spark):
    table = spark.createDataFrame([(1, "a", 200), (2, "b", 404), (3, "c", None)], "id long, t string, s int")
    updates = spark.createDataFrame([(2, "FORBIDDEN", None), (9, "x", 1)], "id long, t string, s int")
    assert rows(T.apply_updates(table, updates, "id", ["t", "s"])) == [
        (1, "a", 200), (2, "FORBIDDEN", None), (3, "c", None)]
    assert rows(T.remove_rows(table, updates, ["id"]), "id") == [(1,), (3,)]


def test_surrogate_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 997, 1, 6).select(((F.col("id") * 101) % 997).alias("k"))
    got = T.with_surrogate_ids(df, ["k"], last_id=40)
    assert rows(got.orderBy("id"), "id", "k") == sorted(
        [(41 + k, k) for k in range(997)], key=lambda r: tuple((False, str(v)) for v in r))


def test_fk_violations(spark):
    codes = T.code_tables(spark)
    found = T.fk_violations({
        "page": spark.createDataFrame(
            [(1, 1, "HTML"), (2, 7, "HTML"), (3, None, "ODD")], "id long, site_id long, page_type_code string"),
        "site": spark.createDataFrame([(1,)], "id long"),
        "page_type": codes.where("code_table = 'page_type'"),
        "data_type": codes.where("code_table = 'data_type'"),
        "link": spark.createDataFrame([(1, 2), (8, 9), (8, 1)], "from_page long, to_page long"),
        "frontier": spark.createDataFrame([(1,)], "page_id long"),
        "page_data": spark.createDataFrame([(1, "PDF"), (4, "PDFX")], "page_id long, data_type_code string"),
        "image": spark.createDataFrame([(3,)], "page_id long"),
    })
    assert rows(found) == sorted([
        ("page_site", "7", 1), ("page_page_type", "ODD", 1), ("link_from_page", "8", 2),
        ("link_to_page", "9", 1), ("page_data_page", "4", 1), ("page_data_data_type", "PDFX", 1)])


def test_codes(spark):
    assert rows(T.code_tables(spark), "code") == sorted((c,) for c in C.PAGE_TYPES + C.DATA_TYPES)


def test_assets(spark):
    long_name = "http://d.com/" + "n" * 250 + ".png"
    links = spark.createDataFrame([
        (1, "http://d.com/a.pdf", "binary"), (1, "http://d.com/a.pdf", "binary"),
        (1, "http://d.com/b.pdfx", "binary"), (1, "http://d.com/c.DOCX", "binary"),
        (1, "http://d.com/d.pdf/", "binary"), (2, "http://w.d.com/i.v1.PNG", "image"),
        (2, "http://d.com/j.jpeg", "image"), (2, "http://d.com/k.jpg", "image"),
        (2, long_name, "image"), (3, "http://d.com/p", "page"),
    ], "page_id long, url string, cls string")
    assert rows(assets.document_rows(links), "url", "data_type_code", "digest") == [
        ("http://d.com/a.pdf", "PDF", None), ("http://d.com/a.pdf", "PDF", None),
        ("http://d.com/c.DOCX", "DOCX", None)]
    found = assets.image_rows(links, AS_OF)
    (long_name,) = writers.rejected(found, "image", COLUMN_LIMITS).collect()
    assert len(long_name.filename) > 255 and long_name.reason == "filename longer than 255"
    assert rows(writers.accepted(found, "image", COLUMN_LIMITS), "filename", "content_type", "accessed_time") == [
        ("http://dcom/k", "jpg", AS_OF), ("http://wdcom/iv1", "png", AS_OF)]
    files = spark.createDataFrame(
        [("http://d.com/a.pdf", bytearray(2_500_000)), ("http://d.com/k.jpg", bytearray(3_500_000))],
        "url string, content binary")
    whole = stage_files(files)
    assert rows(assets.document_rows(links, whole), "url", "n_bytes", "is_cut") == [
        ("http://d.com/a.pdf", 2_500_000, False)] * 2
    cut = assets.document_rows(links, stage_files(files, COLUMN_LIMITS.document_bytes))
    assert rows(cut, "url", "n_bytes", "is_cut") == [("http://d.com/a.pdf", 2_000_000, True)] * 2
    cut = assets.image_rows(links, AS_OF, stage_files(files, COLUMN_LIMITS.image_bytes))
    assert rows(cut, "url", "n_bytes", "is_cut") == [("http://d.com/k.jpg", 3_000_000, True)]


def test_sinks_reject_what_does_not_fit(spark, tmp_path):
    pages = spark.createDataFrame(
        [("http://d/" + "x" * 2991,), ("http://d/" + "x" * 2992,), (None,)], "url string")
    ready = pages.withColumn("page_type_code", F.lit("HTML"))
    assert writers.rejected(ready, "page").count() == 0 and writers.accepted(ready, "page").count() == 3
    (row,) = writers.rejected(ready, "page", COLUMN_LIMITS).collect()
    assert row.reason == "url longer than 3000"
    path = str(tmp_path / "page")
    writers.append_table(ready, "page", path, COLUMN_LIMITS)
    writers.append_table(ready, "page", path, COLUMN_LIMITS)
    stored = readers.read_table(spark, "page", path)
    assert stored.count() == 4
    assert stored.schema == readers.TABLES["page"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_snapshot(ready, "page", path)


def test_bucketed_edges_are_joined_without_a_shuffle(spark, tmp_path):
    edges = spark.range(1000).select(
        (F.col("id") % 50).cast("string").alias("from_url"), F.col("id").cast("string").alias("url"))
    writers.write_bucketed(edges, "edges_by_source", "from_url", 4, str(tmp_path / "edges"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        level = spark.range(50).select(F.col("id").cast("string").alias("from_url"))
        joined = spark.table("edges_by_source").join(level, "from_url")
        plan = plan_of(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1


def test_readers(spark, tmp_path):
    site = tmp_path / "www.d.si"
    site.mkdir()
    (site / "robots.txt").write_text("User-agent: *\nDisallow: /a")
    (site / "index.html").write_text("<body>one\ntwo</body>")
    (site / "x.bin").write_bytes(b"\x00\x01")
    root = str(tmp_path)
    assert rows(readers.read_site_texts(spark, root, "robots.txt", "robots_content")) == [
        ("www.d.si", "User-agent: *\nDisallow: /a")]
    assert rows(readers.read_page_files(spark, root), "html") == [("<body>one\ntwo</body>",)]
    assert rows(readers.read_binary_files(spark, root, "*.bin"), "length") == [(2,)]
    assert rows(readers.seed_urls(spark, ["http://b/", "http://a/"])) == [(0, "http://b/"), (1, "http://a/")]


def test_link_graph_and_report(spark):
    links = spark.createDataFrame(
        [("a", "b"), ("a", "b"), ("b", "a"), ("a", "a"), ("a", "out")], "from_url string, url string")
    graph = reports.link_graph(links, spark.createDataFrame([("a",), ("b",), ("c",)], "url string"))
    assert rows(graph) == [("a", "a"), ("a", "b"), ("b", "a")]
    assert rows(reports.degrees(graph)) == [("a", 2, 2), ("b", 1, 1)]
    pages = spark.createDataFrame(
        [("d", "HTML", 200), ("d", "HTML", 200), ("e", "FRONTIER", None)],
        "domain string, page_type_code string, http_status_code int")
    report = reports.crawl_report(pages)
    assert ("d", "HTML", 200, 2, 0) in rows(report)
    assert (None, None, None, 3, 7) in rows(report)
    assert "CartesianProduct" not in plan_of(report)
