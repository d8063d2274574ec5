from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from crawlmill.schemas import FETCHED_PAGE
from crawlmill.sources.readers import page_stream
from crawlmill.streaming import jobs

AS_OF = datetime(2024, 1, 1)


def page(i, *links):
    return (i, f"http://d.si/{i}", "<body>" + "".join(f"<a href='{u}'>x</a>" for u in links) + "</body>")


def test_each_url_is_written_once_over_restarts(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "work")

    def arrive(*rows_):
        spark.createDataFrame(list(rows_), FETCHED_PAGE).coalesce(1).write.mode("append").parquet(folder)

    def run():
        jobs.new_url_stream(page_stream(spark, folder), root).awaitTermination()
        return rows(jobs.read_batches(spark, f"{root}/urls"), "url")

    arrive(page(1, "/a", "/b", "/a"), page(2, "/a", "/x.xls"))
    assert run() == [("http://d.si/a",), ("http://d.si/b",)]
    arrive(page(3, "/b", "/c"), *[page(i, "/a") for i in range(4, 60)])
    assert run() == [("http://d.si/a",), ("http://d.si/b",), ("http://d.si/c",)]
    arrive(page(60, "/a", "/b"), page(61))
    assert run() == [("http://d.si/a",), ("http://d.si/b",), ("http://d.si/c",)]


def test_a_batch_reads_the_buckets_it_meets(spark, tmp_path):
    store = jobs.KeyedStore(spark, str(tmp_path / "store"), "k string", "k", digits=2).start()
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    store.add(0, keys)
    one = spark.createDataFrame([("17",), (None,)], "k string")
    found = store.before(1, one)
    assert ("17",) in rows(found, "k") and found.count() < 40
    assert len(found.inputFiles()) <= 2 < len(store.before(1, keys).inputFiles())
    assert store.before(0, one).count() == 0 and store.before(1, spark.createDataFrame([], "k string")).count() == 0
    store.add(0, keys)  # the same batch again
    assert store.before(1, keys).count() == 3000
    store.add(1, spark.createDataFrame([("new",), (None,)], "k string"))
    assert store.before(2, spark.createDataFrame([("new",)], "k string")).where("k = 'new'").count() == 1


def test_bounded_state_variant(spark, tmp_path):
    folder = str(tmp_path / "in")
    df = spark.createDataFrame([page(1, "/a"), page(2, "/a", "/b")], FETCHED_PAGE).withColumn(
        "seen", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    df.write.parquet(folder)
    stream = page_stream(spark, folder, schema=df.schema)
    urls = jobs.recent_url_stream(stream, "seen", "1 hour")
    jobs.write_stream(urls, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "url") == [("http://d.si/a",), ("http://d.si/b",)]


def test_content_verdicts_over_batches(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "work")
    schema = "id long, content_hash string"

    def run(*contents):
        spark.createDataFrame(list(contents), schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.content_stream(spark.readStream.schema(schema).parquet(folder), root).awaitTermination()
        return rows(jobs.read_batches(spark, f"{root}/verdicts"), "id", "page_type_code")

    first = [(1, "HTML"), (2, "DUPLICATE"), (3, "HTML")]
    assert run((1, "x"), (2, "x"), (3, "y")) == first
    assert run((4, "y"), (5, "z"), (6, "z")) == first + [(4, "DUPLICATE"), (5, "HTML"), (6, "DUPLICATE")]


def test_repeated_batch_gives_the_same_verdicts(spark, tmp_path):
    """A batch that is run again after a failure must not meet its own hashes."""
    root = str(tmp_path / "work")
    schema = "id long, content_hash string"
    spark.createDataFrame([(1, "x")], "id long, content_hash string").write.parquet(str(tmp_path / "in"))
    jobs.content_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), root).awaitTermination()
    before = rows(jobs.read_batches(spark, f"{root}/verdicts"))
    # Forget that the batch was committed.
    commits = tmp_path / "work" / "checkpoint" / "commits"
    for name in list(commits.iterdir()):
        name.unlink()
    jobs.content_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), root).awaitTermination()
    assert rows(jobs.read_batches(spark, f"{root}/verdicts")) == before


def test_schedule_continues_over_batches(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "work")
    schema = "page_id long, site_id long, time_added timestamp_ntz"
    sites = spark.createDataFrame(
        [(1, None, 4), (2, AS_OF + timedelta(seconds=10), 5)], "id long, next_acces timestamp_ntz, delay int")
    table = {"sites": sites}

    def run(*urls):
        spark.createDataFrame(list(urls), schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        jobs.schedule_stream(stream, lambda session: table["sites"], AS_OF, root).awaitTermination()
        planned = rows(jobs.read_batches(spark, f"{root}/schedule"), "page_id", "fetch_time")
        return {p: (t - AS_OF).seconds for p, t in planned}

    assert run((1, 1, AS_OF), (2, 1, AS_OF), (3, 2, AS_OF)) == {1: 0, 2: 4, 3: 10}
    # A site that comes later, and one that never does.
    later = spark.createDataFrame([(3, AS_OF + timedelta(seconds=7), 2)], sites.schema)
    table["sites"] = sites.unionByName(later)
    second = {1: 0, 2: 4, 3: 10, 4: 8, 5: 15, 6: 7, 7: 9, 8: 0}
    assert run((4, 1, AS_OF), (5, 2, AS_OF), (6, 3, AS_OF), (7, 3, AS_OF), (8, 9, AS_OF)) == second
    assert run((9, 3, AS_OF), (10, 9, AS_OF), (11, 1, AS_OF)) == second | {9: 11, 10: 4, 11: 12}
