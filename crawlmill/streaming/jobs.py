"""Incremental forms of discovery, duplicate test and scheduling.

What a stream has to remember lies in a :class:`KeyedStore`. A micro-batch is reduced to distinct keys by plain
aggregations first, so that a key which is everywhere costs one row per task, and then reads and adds to
only those buckets of the store that its keys fall into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlmill.constants import DEFAULT_CRAWL_DELAY
from crawlmill.functions.times import plus_seconds
from crawlmill.operators import links as L
from crawlmill.operators.content import content_verdicts
from crawlmill.operators.frontier import fetch_schedule
from crawlmill.session import materialize

SPREAD = 16
#: Hexadecimal digits that name a bucket. A batch adds a small file to each bucket it meets, so a short history has few
#: buckets; take one digit more for every sixteenfold of it.
DIGITS = 1


class KeyedStore:
    """Rows by key in folders by the first hexadecimal digits of the key's hash, and by micro-batch.

    A micro-batch adds rows and never changes those of others, so a batch that is repeated replaces its own
    folders and reads only what was there before it. Reading lists and opens the buckets that are asked for.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str, key: str, digits: int = DIGITS) -> None:
        self._spark, self._path, self._key, self._digits = spark, path, key, digits
        self._schema = f"{columns}, bucket string, batch long"

    def _bucket(self, key: Column) -> Column:
        return F.substring(F.md5(key.cast("string")), 1, self._digits)

    def _write(self, rows: DataFrame) -> None:
        (
            rows.write.partitionBy("bucket", "batch").mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").parquet(self._path)
        )

    def start(self) -> KeyedStore:
        """A bucket that is never met, so that there is always something to read."""
        self._write(self._spark.createDataFrame([()], "").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(self._schema).fields[:-2]],
            F.lit("none").alias("bucket"), F.lit(-1).cast("long").alias("batch"),
        ))
        return self

    def before(self, batch: int, keys: DataFrame) -> DataFrame:
        """Rows of earlier batches in the buckets of the given keys."""
        buckets = keys.select(self._bucket(F.col(self._key)).alias("bucket")).distinct()
        met = sorted(r["bucket"] for r in buckets.collect() if r["bucket"])  # at most 16 ** digits
        found = (
            self._spark.read.schema(self._schema).option("basePath", self._path)
            .parquet(f"{self._path}/bucket={{{','.join(['none', *met])}}}")
        )
        return found.where((F.col("batch") < batch) & (F.col("bucket") != "none"))

    def add(self, batch: int, rows: DataFrame) -> None:
        rows = rows.withColumns({"bucket": self._bucket(F.col(self._key)), "batch": F.lit(batch).cast("long")})
        self._write(rows.where(F.col("bucket").isNotNull()).repartition("bucket"))


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_links(pages: DataFrame, search_domains: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return L.page_links(L.extract_links(pages, search_domains, keep, (L.HREF, L.ONCLICK)))


def new_url_stream(
    pages: DataFrame, root: str, search_domains: Sequence[str] = (), digits: int = DIGITS
) -> StreamingQuery:
    """URLs of arriving pages, each written once to ``root/urls``, one folder per micro-batch.

    A batch first reduces its own URLs to distinct ones, on the map side too. Of the URLs seen before it reads the
    buckets that it meets, and the exact anti join decides.
    """
    store = KeyedStore(pages.sparkSession, f"{root}/known", "url string", "url", digits).start()

    def each(batch: DataFrame, number: int) -> None:
        urls = materialize(_stream_links(batch, search_domains, ("page_id",)).select("url").distinct(), f"urls-{number}")
        fresh = urls.join(store.before(number, urls).select("url"), "url", "left_anti")
        target = f"{root}/urls/batch={number}"
        fresh.write.mode("overwrite").parquet(target)
        store.add(number, urls.sparkSession.read.schema(fresh.schema).parquet(target))

    return _run(pages, each, f"{root}/checkpoint")


def recent_url_stream(
    pages: DataFrame, event_time: str, delay: str = "1 day", search_domains: Sequence[str] = (), spread: int = SPREAD
) -> DataFrame:
    """Stream of page URLs, each emitted once within ``delay``: the state covers no more.

    Duplicates go in two steps, within each of ``spread`` parts of the pages and then over all. A URL that
    every page links to thus meets in many tasks before it meets in one.
    """
    part = F.pmod(F.xxhash64("page_id"), F.lit(spread)).cast("int")
    links = _stream_links(pages, search_domains, ("page_id", event_time))
    urls = links.select("url", event_time, part.alias("_part")).withWatermark(event_time, delay)
    return (
        urls.dropDuplicatesWithinWatermark(["url", "_part"])
        .select("url", event_time)
        .dropDuplicatesWithinWatermark(["url"])
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything available to parquet files, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def content_stream(contents: DataFrame, root: str, digits: int = DIGITS) -> StreamingQuery:
    """Verdict HTML or DUPLICATE for arriving ``contents(id, content_hash)``.

    Verdicts are written to ``root/verdicts``, one folder per micro-batch. The hashes stored before are
    read in the buckets that the batch meets, so that what it reads follows the batch and not the history.
    """
    store = KeyedStore(contents.sparkSession, f"{root}/hashes", "content_hash string", "content_hash", digits).start()

    def each(batch: DataFrame, number: int) -> None:
        arrived = materialize(batch.select("id", "content_hash"), f"contents-{number}")
        verdicts = content_verdicts(arrived, (), store.before(number, arrived))
        target = f"{root}/verdicts/batch={number}"
        verdicts.write.mode("overwrite").parquet(target)
        written = arrived.sparkSession.read.schema(verdicts.schema).parquet(target)
        store.add(number, written.where(F.col("page_type_code") == "HTML").select("content_hash"))

    return _run(contents, each, f"{root}/checkpoint")


def schedule_stream(
    urls: DataFrame, sites: Callable[[SparkSession], DataFrame], as_of: datetime, root: str, digits: int = DIGITS
) -> StreamingQuery:
    """Fetch times for arriving ``urls(page_id, site_id, time_added)``.

    Each micro-batch is scheduled behind the earlier ones. What a site is left with is one row for each batch that
    meets it; of these the last counts. ``sites`` gives the current site table and is asked for each batch, so sites
    that come later count; a site that has no row yet has the default delay. Only the sites that the batch meets are
    read from the table and the store, and only they are written.

    Ranks come from the sort of :func:`fetch_schedule`, not from a state function, which would need all URLs of
    a site in one task.
    """
    store = KeyedStore(urls.sparkSession, f"{root}/sites", "id long, next_acces timestamp_ntz", "id", digits).start()

    def each(batch: DataFrame, number: int) -> None:
        session: SparkSession = batch.sparkSession
        arrived = materialize(batch, f"schedule-{number}")
        met = arrived.select(F.col("site_id").alias("id")).where(F.col("id").isNotNull()).distinct()
        met = materialize(met, f"met-{number}")
        current = sites(session).select("id", "next_acces", F.col("delay").cast("int").alias("delay"))
        left = store.before(number, met).groupBy("id").agg(F.max_by("next_acces", "batch").alias("_left"))
        before = met.join(current, "id", "left").join(left, "id", "left").select(
            "id", F.coalesce("_left", "next_acces").alias("next_acces"),
            F.coalesce("delay", F.lit(DEFAULT_CRAWL_DELAY)).alias("delay"),
        )
        before = materialize(before, f"sites-{number}")
        plan = fetch_schedule(arrived, before, as_of)
        target = f"{root}/schedule/batch={number}"
        plan.write.mode("overwrite").parquet(target)
        last = (
            session.read.schema(plan.schema).parquet(target)
            .groupBy(F.col("site_id").alias("id")).agg(F.max("fetch_time").alias("_last"))
        )
        after = before.join(last, "id").select("id", plus_seconds(F.col("_last"), F.col("delay")).alias("next_acces"))
        store.add(number, after)

    return _run(urls, each, f"{root}/checkpoint")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batch folders below ``path``."""
    return spark.read.parquet(path)
