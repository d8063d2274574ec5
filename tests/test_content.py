from conftest import plan_of, rows
from pyspark.sql import functions as F

from crawlmill.functions import html as H
from crawlmill.operators import content


def hashes(spark, *htmls):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "id long, html string")
    return [r[0] for r in df.orderBy("id").select(H.content_hash(F.col("html"))).collect()]


def test_head_and_whitespace_around_tags_do_not_matter(spark):
    a, b, c, d, e = hashes(
        spark,
        "<html><head><title>1</title></head><body><p>one two</p><p>three</p></body></html>",
        "<html><head></head>\n<body>\n  <p> one two </p>\n\t<p>three</p></body></html>\n",
        "<html><body><p>one two</p><p>three</p></body></html>",
        "<html><body><p>one  two</p><p>three</p></body></html>",
        None,
    )
    assert a == b == c
    assert d != a  # blanks inside a text are content
    assert e is None


def test_whitespace_inside_pre_counts(spark):
    a, b, c, d = hashes(
        spark, "<body><p>x</p> <pre> <b>1</b>\n</pre> <p>y</p></body>",
        "<body><p>x</p><pre> <b>1</b>\n</pre>\n<p> y</p></body>",
        "<body><p>x</p><pre><b>1</b></pre><p>y</p></body>",
        "<body><p>x</p><PRE class='c'> <b>1</b>\n</PRE><p>y</p></body>",
    )
    assert a == b
    assert len({a, c, d}) == 3


def test_header_is_not_head_and_comments_count(spark):
    a, b, c = hashes(
        spark, "<body><header>x</header></body>", "<body></body>", "<body><!-- <head>x</head> --></body>"
    )
    assert len({a, b, c}) == 3


CONTENTS = [(1, 9, "x"), (2, 3, "x"), (3, 5, "y"), (4, 5, None), (5, 3, "x"), (6, 7, "z")]


def test_first_page_keeps_the_content(spark):
    df = spark.createDataFrame(CONTENTS, "id long, ord long, content_hash string")
    verdicts = content.content_verdicts(df, ["ord"])
    assert rows(verdicts, "id", "page_type_code") == [
        (1, "DUPLICATE"), (2, "HTML"), (3, "HTML"), (4, None), (5, "DUPLICATE"), (6, "HTML"),
    ]
    assert [r[0] for r in rows(content.content_verdicts(df).where("page_type_code = 'HTML'"), "id")] == [
        1, 3, 6
    ]


def test_known_hashes_make_duplicates(spark):
    df = spark.createDataFrame(CONTENTS, "id long, ord long, content_hash string")
    known = spark.createDataFrame([("x",), ("z",)], "content_hash string")
    verdicts = content.content_verdicts(df, ["ord"], known)
    assert rows(verdicts.where("page_type_code = 'HTML'"), "id") == [(3,)]


def test_seen_elsewhere(spark):
    df = spark.createDataFrame(CONTENTS, "id long, ord long, content_hash string")
    assert rows(content.seen_elsewhere(df, df), "id") == [(1,), (2,), (5,)]
    stored = spark.createDataFrame([(3, "y"), (60, "z")], "id long, content_hash string")
    assert rows(content.seen_elsewhere(df, stored), "id") == [(6,)]


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select("id", F.lit("same").alias("content_hash"))
    plan = plan_of(content.first_holders(df, ()))
    assert plan.count("HashAggregate") == 2
    assert content.content_verdicts(df).where("page_type_code = 'HTML'").count() == 1


def test_a_page_visited_again_is_no_duplicate_of_itself(spark):
    pages = spark.createDataFrame([(7, "h"), (9, "h"), (8, "k"), (5, "m"), (6, None)], "id long, content_hash string")
    known = spark.createDataFrame([(7, "h"), (8, "k"), (3, "k"), (4, "m")], "id long, content_hash string")
    verdicts = dict(rows(content.content_verdicts(pages, (), known), "id", "page_type_code"))
    assert verdicts == {7: "HTML", 9: "DUPLICATE", 8: "DUPLICATE", 5: "DUPLICATE", 6: None}
