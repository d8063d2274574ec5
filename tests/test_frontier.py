from datetime import datetime, timedelta

from conftest import plan_of, rows
from pyspark.sql import functions as F

from crawlmill.operators import frontier as FR
from crawlmill.operators.ranking import first_n_per_key, numbered, rank_in_group

AS_OF = datetime(2024, 1, 1, 12)
T0 = datetime(2024, 1, 1)
FRONTIER = "page_id long, time_added timestamp_ntz, occupied boolean"


def tables(spark):
    frontier = spark.createDataFrame([
        (5, T0, False), (4, T0, False), (3, None, False), (2, T0 - timedelta(1), True),
        (1, T0 - timedelta(2), False), (6, T0 + timedelta(hours=1), False), (99, T0, False)], FRONTIER)
    pages = spark.createDataFrame(
        [(1, 30), (2, 10), (3, 10), (4, 10), (5, 20), (6, 20)], "id long, site_id long")
    sites = spark.createDataFrame(
        [(10, AS_OF, 4), (20, None, 3), (30, AS_OF + timedelta(seconds=1), 7)],
        "id long, next_acces timestamp_ntz, delay short")
    return frontier, pages, sites


def test_ready_and_pop(spark):
    frontier, pages, sites = tables(spark)
    ready = FR.ready_pages(frontier, pages, sites, AS_OF)
    # 1: site opens later, 2: occupied, 99: no page
    assert rows(ready, "page_id") == [(3,), (4,), (5,), (6,)]
    assert [r["page_id"] for r in FR.next_pages(ready, 4).collect()] == [4, 5, 6, 3]
    assert "TakeOrderedAndProject" in plan_of(FR.next_pages(ready))
    popped = FR.next_pages(ready)
    after = FR.occupy(frontier, popped)
    assert rows(after.where("occupied"), "page_id") == [(2,), (4,)]
    assert rows(FR.release(after).where("occupied"), "page_id") == []
    back = FR.give_back(after, spark.createDataFrame([(4,)], "page_id long"))
    assert rows(back.where("occupied"), "page_id") == [(2,)]
    assert rows(back, "page_id", "time_added") == rows(frontier, "page_id", "time_added")


def test_batch_per_site(spark):
    frontier, pages, sites = tables(spark)
    batch = FR.next_batch(FR.ready_pages(frontier, pages, sites, AS_OF), 1)
    assert rows(batch, "page_id", "site_rank") == [(4, 1), (5, 1)]


def test_batch_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id").alias("page_id"), (F.col("id") % 3).alias("site_id"))
    assert plan_of(first_n_per_key(df, ["site_id"], ["page_id"], 2, "r")).count("WindowGroupLimit") == 2


def test_remove_and_requeue(spark):
    frontier, _, _ = tables(spark)
    some = spark.createDataFrame([(1,), (2,)], "page_id long")
    assert rows(FR.remove(frontier, some), "page_id") == [(3,), (4,), (5,), (6,), (99,)]
    again = FR.requeue(frontier, some, AS_OF)
    assert rows(again.where("page_id < 3")) == [(1, AS_OF, False), (2, AS_OF, False)]
    assert again.count() == frontier.count()


def one_by_one(urls, sites):
    """Fetch times by asking for one URL after the other."""
    opens = {i: max(n or AS_OF, AS_OF) for i, n, _ in sites}
    delay = {i: d for i, _, d in sites}
    times = {}
    for page, site, _ in sorted(urls, key=lambda u: (u[2] is None, u[2] or T0, u[0])):
        times[page] = opens[site]
        opens[site] += timedelta(seconds=delay[site])
    return times


def test_schedule_equals_asking_one_by_one(spark):
    sites = [(10, AS_OF + timedelta(minutes=1), 4), (20, None, 3), (30, T0, 7)]
    # Site 10 holds most rows, many of them with equal times.
    urls = [(i, 10 if i % 4 else 20 + 10 * (i % 8 == 0), None if i % 50 == 0 else T0 + timedelta(i // 100))
            for i in range(2000)]
    u = spark.createDataFrame(urls, "page_id long, site_id long, time_added timestamp_ntz").repartition(7)
    s = spark.createDataFrame(sites, "id long, next_acces timestamp_ntz, delay short")
    expected = one_by_one(urls, sites)
    for limit in (10_000, 400, 1):
        got = {r["page_id"]: r["fetch_time"] for r in FR.fetch_schedule(u, s, AS_OF, limit).collect()}
        assert got == expected


def test_hot_group_is_split(spark):
    df = spark.range(0, 50_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("g"))
    ranked = rank_in_group(df, "g", ["id"], "r").where("g = 1").select("id", "r").collect()
    members = sorted(set(range(0, 50_000, 3)) | {1})
    assert sorted((r["r"], r["id"]) for r in ranked) == list(enumerate(members, 1))


def test_sequence_follows_the_order(spark):
    df = spark.range(0, 1000, 1, 5).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = numbered(df, ["k"], "seq").orderBy("seq").collect()
    assert [r["k"] for r in got] == list(range(1000))
    assert len({r["seq"] for r in got}) == 1000


def test_long_waits(spark):
    u = spark.range(200_000).select(
        F.col("id").alias("page_id"), F.lit(1).cast("long").alias("site_id"),
        F.lit(None).cast("timestamp_ntz").alias("time_added"))
    s = spark.createDataFrame([(1, None, 86400)], "id long, next_acces timestamp_ntz, delay int")
    last = FR.fetch_schedule(u, s, AS_OF).agg(F.max("fetch_time")).first()[0]
    assert last == AS_OF + timedelta(seconds=199_999 * 86400)
    # A delay without end stops no job.
    s = spark.createDataFrame([(1, None, 2**31 - 1)], "id long, next_acces timestamp_ntz, delay int")
    assert FR.fetch_schedule(u, s, AS_OF).select(F.max("fetch_time").cast("string")).first()[0]


def test_urls_of_unknown_sites_are_scheduled(spark):
    u = spark.createDataFrame([(1, 7, T0), (2, 7, T0), (3, 10, T0), (4, None, T0)], "page_id long, site_id long, time_added timestamp_ntz")
    s = spark.createDataFrame([(10, AS_OF + timedelta(1), 9)], "id long, next_acces timestamp_ntz, delay int")
    due = {r.page_id: r.fetch_time for r in FR.fetch_schedule(u, s, AS_OF).collect()}
    assert due == {1: AS_OF, 2: AS_OF + timedelta(seconds=4), 3: AS_OF + timedelta(1), 4: AS_OF}
