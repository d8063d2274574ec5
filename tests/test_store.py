import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from crawlmill.operators import assets
from crawlmill.operators.store import read_first_of, read_wanted, stage_files
from crawlmill.session import materialize


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> list[str]:
    """Shuffles of the plan (broadcasts are none)."""
    return [line for line in plan_of(df).splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


@pytest.mark.parametrize("words", [1, 3, 1 << 22])
def test_wanted_rows_come_back_whole(spark, no_broadcasts, words):
    written = materialize(spark.range(1000).repartition(7).select(
        "id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("key"), F.repeat(F.col("id").cast("string"), 50).alias("html")), "wide")
    draw = random.Random(words)
    for wanted in (set(), {3}, {5, 10, 999}, set(draw.sample(range(1000), 500)), set(range(1000))):
        keys = spark.createDataFrame([(k,) for k in wanted] * 2 + [(None,), (5000,)], "key long")
        found = read_wanted(written, "key", keys, ["id", "html"], words)
        assert rows(found) == sorted(((k, str(k) * 50) for k in wanted if k % 10), key=lambda r: (False, str(r[0])))
        assert not exchanges(found)


def test_files_without_wanted_rows_are_not_read(spark):
    written = materialize(spark.range(0, 800, 1, 8).select("id", F.lit("x").alias("html")), "wide")
    found = read_wanted(written, "id", spark.createDataFrame([(5,), (750,)], "id long"), ["id"])
    read = set(found.inputFiles()) & set(written.inputFiles())
    assert len(read) == 2 < len(written.inputFiles()) and rows(found) == [(5,), (750,)]


def test_one_row_of_each_key(spark, no_broadcasts):
    written = materialize(spark.range(600).repartition(5).select((F.col("id") % 7).alias("key"), "id"), "wide")
    found = read_first_of(written, "key", ["key", "id"])
    assert not exchanges(found) and sorted(r["key"] for r in found.collect()) == list(range(7))
    assert all(r["id"] % 7 == r["key"] for r in found.collect())


def test_a_payload_that_all_pages_link_to_is_stored_once(spark, no_broadcasts):
    links = spark.range(5000).select(
        F.col("id").alias("page_id"), F.lit("image").alias("cls"),
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("http://d/"), F.col("id").cast("string"), F.lit(".png")))
        .otherwise("http://d/logo.png").alias("url"))
    urls = links.select("url").distinct()
    files = stage_files(urls.select("url", F.encode(F.when(F.col("url").contains("logo"), F.repeat(F.lit("L"), 9000)).otherwise("same"), "UTF-8").alias("content")).repartition(4))
    found = assets.image_rows(links, datetime(2024, 1, 1), files)
    assert found.count() == 5000 and "data" not in found.columns
    contents = files.contents()
    assert not exchanges(contents)
    assert rows(contents.select(F.length("data"))) == [(4,), (9000,)]
    known = contents.where(F.length("data") == 4).select("digest")
    assert rows(files.contents(known).select(F.length("data"))) == [(9000,)]


def test_nothing_written_and_null_contents(spark):
    empty = stage_files(spark.createDataFrame([], "url string, content binary"))
    assert empty.contents().collect() == [] and empty.refs.collect() == []
    null = stage_files(spark.createDataFrame([("u", None)], "url string, content binary"))
    assert rows(null.contents().select(F.length("data"))) == [(0,)]
