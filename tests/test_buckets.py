import random
from datetime import datetime, timedelta
from pathlib import Path

from conftest import plan_of, rows
from pyspark.sql import functions as F

from crawlmill.operators import frontier as FR
from crawlmill.sources.buckets import BucketTable, TimeQueue


def files(path):
    return {f for f in Path(path).glob("*=*/*.parquet")}


def test_updates_and_deletes_leave_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.range(200).select("id", F.lit("old").alias("code"), F.lit(1).alias("n"))
    table = BucketTable(spark, path, start.schema, "id", 8).create(start)
    before = files(path)
    table.update(spark.createDataFrame([(7, "new"), (999, "none")], "id long, code string"), ["code"])
    after = files(path)
    assert 0 < len(before - after) <= 2 and len(before & after) >= 6
    assert rows(table.read().where("code = 'new'")) == [(7, "new", 1)] and table.read().count() == 200
    table.update(spark.createDataFrame([(7, None)], "id long, code string"), ["code"])
    assert rows(table.read().where("code is null"), "id") == [(7,)]
    untouched = files(path)
    table.delete(spark.createDataFrame([(7,), (None,), (5000,)], "id long"))
    assert table.read().count() == 199 and len(untouched & files(path)) >= 6
    table.delete(spark.createDataFrame([], "id long"))
    assert table.read().count() == 199


def test_changes_equal_a_plain_table_and_may_be_repeated(spark, tmp_path):
    draw = random.Random(2)
    expected = {i: "a" for i in range(60)}
    start = spark.createDataFrame(list(expected.items()), "id long, code string")
    table = BucketTable(spark, str(tmp_path / "t"), start.schema, "id", 4).create(start)
    for turn in range(3):
        new = {draw.randrange(80): f"v{turn}" for _ in range(9)}
        gone = draw.sample(sorted(expected), 15)
        for _ in range(2):
            table.update(spark.createDataFrame(list(new.items()), "id long, code string"), ["code"])
        expected |= {k: v for k, v in new.items() if k in expected}
        for _ in range(2):
            table.delete(spark.createDataFrame([(k,) for k in gone], "id long"))
        expected = {k: v for k, v in expected.items() if k not in gone}
        assert rows(table.read()) == sorted(expected.items(), key=str) or dict(map(tuple, table.read().collect())) == expected
    table.delete(table.read().select("id"))
    assert table.read().collect() == []


NOON = datetime(2024, 1, 1, 12)


def test_a_pop_reads_the_oldest_days_only(spark, tmp_path):
    queue = spark.createDataFrame(
        [(i, NOON + timedelta(days=i // 10, minutes=i % 7), i % 10 > 3) for i in range(300)] + [(999, None, False)],
        "page_id long, time_added timestamp_ntz, occupied boolean")
    days = TimeQueue(spark, str(tmp_path / "q"), queue.schema, "time_added").create(queue)
    assert len(days.days()) == 31 and days.days()[-1] == "none"
    seen = []

    def pick(some):
        seen.append(len(set(some.inputFiles())))
        return FR.next_pages(some.where(~F.col("occupied")), 3)

    plain = rows(FR.next_pages(queue.where(~F.col("occupied")), 3))
    assert rows(days.oldest(pick, 3)) == plain and len(seen) == 1
    plan = plan_of(days.read().where(F.col("_day").isin("2024-01-01")))
    assert "PartitionFilters: [(_day" in plan or "PartitionFilters: [isnotnull(_day" in plan
    late = lambda some: FR.next_pages(some.where(F.col("page_id") >= 290))
    assert rows(days.oldest(late), "page_id") == [(294,)]
    assert rows(days.oldest(lambda some: FR.next_pages(some.where("page_id = 999"))), "page_id") == [(999,)]
    assert days.oldest(lambda some: FR.next_pages(some.where("page_id < 0"))).collect() == []


def test_an_empty_queue(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, time_added timestamp_ntz, occupied boolean")
    days = TimeQueue(spark, str(tmp_path / "q"), empty.schema, "time_added").create(empty)
    assert days.oldest(FR.next_pages).collect() == []
