"""The crawl tables in a folder, and the crawl as a sequence of table versions.

``site``, ``page`` and ``frontier`` change row by row, so each step writes a new version
of them. ``link``, ``page_data``, ``image`` and ``content`` only grow, so each step adds one
folder; the wide ones among them (markup, files) are never written twice. A step reads
version n and writes version n + 1, which exists once its folders are noted in
``versions``. A step that fails half-way leaves version n as it is, and running it again
starts over in fresh folders. Fetching happens outside: ``select`` says what to fetch and
when, ``apply`` takes the responses.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.functions.times import ntz, plus_seconds
from crawlmill.functions.urls import url_scheme
from crawlmill.operators import frontier as FR, robots as R
from crawlmill.operators.discovery import seed_frontier
from crawlmill.operators.ranking import first_n_per_key
from crawlmill.operators.tables import apply_updates, with_surrogate_ids
from crawlmill.operators.store import Payloads
from crawlmill.plans.page_step import process_batch
from crawlmill.schemas import FRONTIER, IMAGE, LINK, PAGE, PAGE_DATA, PAYLOAD, SITE
from crawlmill.session import materialize, new_work_path
from crawlmill.sources.writers import accepted

# The markup lives in its own table, so that a new page version does not carry it along. It
# holds the bodies that were stored; the page table tells which of them count.
CONTENT = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("html_content", T.StringType()),
])
NARROW_PAGE = T.StructType([f for f in PAGE.fields if f.name != "html_content"])

VERSIONS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("path", T.StringType()),
])

VERSIONED = {"site": SITE, "page": NARROW_PAGE, "frontier": FRONTIER}
GROWING = {"link": LINK, "page_data": PAGE_DATA, "image": IMAGE, "content": CONTENT, "payload": PAYLOAD}


@dataclass(frozen=True)
class CrawlDb:
    """One version of the crawl tables: table name to the folders that hold it."""

    spark: SparkSession
    root: str
    version: int
    folders: dict[str, tuple[str, ...]]

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> CrawlDb:
        """Empty tables below ``root``, a folder that all executors can reach."""
        return cls(spark, root.rstrip("/"), 0, {name: () for name in {**VERSIONED, **GROWING}})

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> CrawlDb:
        """The last version below ``root``. The list of folders is a few rows per step."""
        db = cls.create(spark, root)
        noted = spark.read.schema(VERSIONS).json(f"{db.root}/versions")
        for row in sorted(noted.collect()):
            db = replace(
                db, version=row["version"],
                folders=db._with_folder(row["table_name"], row["path"]),
            )
        return db

    def _with_folder(self, name: str, path: str) -> dict[str, tuple[str, ...]]:
        older = () if name in VERSIONED else self.folders[name]
        return {**self.folders, name: (*older, path)}

    def table(self, name: str) -> DataFrame:
        schema = {**VERSIONED, **GROWING}[name]
        if not self.folders[name]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.folders[name])

    def pages_with_content(self) -> DataFrame:
        """The page table with ``html_content`` for the pages that have a content hash."""
        stored = self.table("content").select(
            F.col("page_id").alias("id"), F.col("html_content").alias("_html")
        )
        return self.table("page").join(stored, "id", "left").withColumn(
            "html_content", F.when(F.col("content_hash").isNotNull(), F.col("_html"))
        ).select(*PAGE.fieldNames())

    def last_id(self, name: str) -> int:
        return self.table(name).agg(F.max("id").alias("last")).first()["last"] or 0

    def _next(self, **tables: DataFrame) -> CrawlDb:
        """Write the given tables and return the version that uses them.

        The tables do not depend on each other, so their jobs run side by side.
        """
        step = new_work_path(self.spark, "step").rsplit("-", 1)[1]

        def write(name: str) -> str:
            df = tables[name] if name == "content" else accepted(tables[name], name)
            path = f"{self.root}/{name}/{self.version + 1}-{step}"
            schema = {**VERSIONED, **GROWING}[name]
            df.select(*[
                F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields
            ]).write.parquet(path)
            return path

        with ThreadPoolExecutor(len(tables)) as jobs:
            paths = dict(zip(tables, jobs.map(write, tables)))
        number = self.version + 1
        noted = self.spark.createDataFrame([(number, *item) for item in paths.items()], VERSIONS)
        noted.coalesce(1).write.mode("append").json(f"{self.root}/versions")
        db = replace(self, version=number)
        for name, path in paths.items():
            db = replace(db, folders=db._with_folder(name, path))
        return db

    # --- steps ----------------------------------------------------------------------

    def start(self, seeds: DataFrame, as_of: datetime) -> CrawlDb:
        """Queue the seeds if the frontier is empty; free all rows of the frontier."""
        new = seed_frontier(seeds, self.table("frontier"), self.table("page"), as_of)
        places = seeds.groupBy("url").agg(F.min("seed_order").alias("seed_order"))
        ordered = materialize(new.join(places, "url"), "seeds")
        site, page, fresh = self._add_pages(ordered, ["seed_order"], as_of)
        return self._next(
            site=site, page=page,
            frontier=FR.release(self.table("frontier")).unionByName(fresh),
        )

    def new_domains(self, as_of: datetime) -> DataFrame:
        """Domains that the next ``select`` visits first: their robots files are needed."""
        ready = FR.ready_pages(
            self.table("frontier"), self.table("page"), self.table("site"), as_of
        )
        unvisited = self.table("site").where(F.col("robots_content").isNull())
        return unvisited.join(
            ready.select(F.col("site_id").alias("id")).distinct(), "id", "left_semi"
        ).select("domain")

    def select(
        self,
        as_of: datetime,
        per_site: int = 1,
        fetched: DataFrame | None = None,
        search_domains: Sequence[str] = (),
    ) -> tuple[CrawlDb, DataFrame]:
        """Take the next pages of every open site.

        Returns the next version and the fetch list ``page_id, url, old_type, old_status,
        fetch_time``. Fetched pages are occupied, forbidden ones are marked and leave the
        frontier, sites get their next access time, and sitemaps of new sites (``fetched``)
        add pages.
        """
        sites = materialize(R.with_current_robots(self.table("site"), fetched), "sites")
        ready = FR.ready_pages(
            self.table("frontier"), self.table("page"), self.table("site"), as_of
        )
        named = FR.next_batch(ready, per_site).join(
            self.table("page").select(
                F.col("id").alias("page_id"), "url",
                F.col("page_type_code").alias("old_type"),
                F.col("http_status_code").alias("old_status"),
            ), "page_id"
        ).join(sites.select(F.col("id").alias("site_id"), "domain"), "site_id")
        judged = materialize(
            R.robots_verdicts(named, R.site_states(sites), carry=("first_visit",)), "judged"
        )
        ranked = first_n_per_key(
            judged.where("allowed"), ["site_id"], ["site_rank"], per_site, "place"
        )
        fetch = materialize(ranked.select(
            "page_id", "url", "old_type", "old_status",
            plus_seconds(ntz(as_of), (F.col("place") - 1) * F.col("delay")).alias("fetch_time"),
        ), "fetch")
        forbidden = judged.where(~F.col("allowed")).select(
            F.col("page_id").alias("id"), "page_id", F.lit("FORBIDDEN").alias("page_type_code"),
            F.lit(None).cast("int").alias("http_status_code"),
            ntz(as_of).alias("accessed_time"),
        )
        visited = self._visited_sites(sites, judged, as_of)
        page = apply_updates(
            self.table("page"), forbidden, "id",
            ["page_type_code", "http_status_code", "accessed_time"],
        )
        frontier = FR.occupy(FR.remove(self.table("frontier"), forbidden), fetch)
        chosen = self._next(site=visited, page=page, frontier=frontier)
        return chosen._add_sitemaps(sites, judged, as_of, search_domains), fetch

    def apply(
        self,
        responses: DataFrame,
        as_of: datetime,
        search_domains: Sequence[str] = (),
        files: Payloads | None = None,
        final_dequeue: bool = True,
    ) -> CrawlDb:
        """Take responses: the fetch list with ``status`` and ``html``.

        They carry all the step needs of their page, so the markup passes no shuffle: it is
        read once, for its features and for the body that may be stored.
        """
        page = self.table("page")
        batch = responses.select("page_id", "url", "old_type", "old_status", "status", "html")
        known = page.where(F.col("content_hash").isNotNull()).select("content_hash")
        result = process_batch(
            batch, page, self.table("site"), known, as_of, search_domains, final_dequeue, files
        )
        changed = result.pages.where(F.col("accessed_time").isNotNull()).withColumnRenamed(
            "page_id", "id"
        )
        updated = apply_updates(
            page, changed, "id",
            ["page_type_code", "http_status_code", "content_hash", "accessed_time"],
        )
        found = result.discovery.found.withColumnRenamed("page_id", "from_page")
        site, grown, fresh = self._add_pages(
            found, ["from_page", "source", "pos"], as_of, updated
        )
        again = result.pages.where(F.col("requeue"))
        frontier = FR.requeue(
            FR.remove(self.table("frontier"), result.frontier_removed()), again, as_of
        ).unionByName(fresh)
        by_url = grown.select(F.col("id").alias("to_page"), "url")
        links = found.select("from_page", "url").join(by_url, "url")
        return self._next(
            site=site, page=grown, frontier=frontier,
            link=links.select("from_page", "to_page"),
            content=result.contents(),
            page_data=with_surrogate_ids(
                result.documents, ["page_id", "url"], self.last_id("page_data")
            ),
            image=with_surrogate_ids(result.images, ["page_id", "url"], self.last_id("image")),
            **({} if files is None else {"payload": files.contents(self.table("payload"))}),
        )

    # --- parts of the steps ---------------------------------------------------------------

    def _visited_sites(self, sites: DataFrame, judged: DataFrame, as_of: datetime) -> DataFrame:
        """Sites after a selection: robots texts, delay, and the time behind the last fetch."""
        visits = judged.groupBy(F.col("site_id").alias("id")).agg(
            F.sum(F.col("allowed").cast("int")).alias("_n"),
            F.any_value("delay").alias("_delay"),
        )
        turns = F.when(F.col("first_visit"), F.greatest("_n", F.lit(1))).otherwise(F.col("_n"))
        moved = F.col("_n").isNotNull() & (turns > 0)
        seen = F.col("_n").isNotNull() & F.col("first_visit")
        stored = self.table("site").select("id", F.col("robots_content").alias("_stored"))
        return sites.join(visits, "id", "left").join(stored, "id").select(
            "id", "domain",
            F.when(F.col("_n").isNull(), F.col("_stored"))
            .otherwise(F.col("robots_content")).alias("robots_content"),
            F.when(F.col("_n").isNotNull() | ~F.col("first_visit"), F.col("sitemap_content"))
            .alias("sitemap_content"),
            F.when(moved, plus_seconds(ntz(as_of), turns * F.col("_delay")))
            .otherwise(F.col("next_acces")).alias("next_acces"),
            F.when(seen, F.col("_delay")).otherwise(F.col("delay")).alias("delay"),
        )

    def _add_sitemaps(
        self, sites: DataFrame, judged: DataFrame, as_of: datetime, search_domains: Sequence[str]
    ) -> CrawlDb:
        first = judged.where(F.col("first_visit")).groupBy("domain").agg(
            F.min("page_id").alias("first_page"), F.min_by("url", "page_id").alias("_url")
        ).withColumn("scheme", url_scheme(F.col("_url")))
        maps = sites.where(F.col("sitemap_content").isNotNull()).select(
            "domain", "sitemap_content"
        ).join(first.drop("_url"), "domain")
        located = R.sitemap_frontier(
            maps, self.table("page"), as_of, search_domains, ("first_page", "scheme")
        )
        new = materialize(located.withColumnRenamed("site_domain", "domain"), "sitemap-pages")
        if new.isEmpty():
            return self
        _, page, fresh = self._add_pages(new, ["first_page", "pos"], as_of, accessed=True)
        return self._next(page=page, frontier=self.table("frontier").unionByName(fresh))

    def _add_pages(
        self, new: DataFrame, order: Sequence[str], as_of: datetime,
        page: DataFrame | None = None, accessed: bool = False,
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Site and page tables with the new URLs, and frontier rows for them.

        ``new`` is a written table ``url, domain`` and the order columns. Ids follow the
        order, so that rows of equal time are taken from the frontier in that order.
        """
        page = self.table("page") if page is None else page
        site = self.table("site")
        domains = new.select("domain").distinct().join(site.select("domain"), "domain", "left_anti")
        grown_site = site.unionByName(
            with_surrogate_ids(domains, ["domain"], self.last_id("site")),
            allowMissingColumns=True,
        )
        rows = with_surrogate_ids(
            new.select("url", "domain", *order), order, self.last_id("page")
        ).join(grown_site.select(F.col("id").alias("site_id"), "domain"), "domain")
        pages = rows.select(
            "id", "site_id", F.lit("FRONTIER").alias("page_type_code"), "url",
            F.lit(None).cast("int").alias("http_status_code"),
            F.when(F.lit(accessed), ntz(as_of)).alias("accessed_time"),
            F.lit(None).cast("string").alias("content_hash"),
        )
        fresh = rows.select(
            F.col("id").alias("page_id"), ntz(as_of).alias("time_added"),
            F.lit(False).alias("occupied"),
        )
        return grown_site, page.unionByName(pages), fresh
