"""The registered queries: each operator over the given or the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlmill.catalog import fixtures as X
from crawlmill.functions import html as H
from crawlmill.functions.times import ntz
from crawlmill.functions.urls import (
    in_scope, site_of, url_netloc, url_path, url_scheme, with_canonical_url,
)
from crawlmill.limits import COLUMN_LIMITS
from crawlmill.operators import (
    assets, content, discovery, frontier as FR, links as L, reports, robots as R, tables as T,
    transitions,
)
from crawlmill.operators.links import extract_links, page_links
from crawlmill.operators.store import Payloads, stage_files
from crawlmill.operators.url_index import UrlIndex, unseen_by_index
from crawlmill.plans.bfs import bfs_levels as search_levels
from crawlmill.plans.crawl_db import CrawlDb
from crawlmill.plans.page_step import page_features, process_batch as run_batch
from crawlmill.plans.replay import Replay, prepare_corpus, replay
from crawlmill.session import materialize, materialize_all, new_work_path
from crawlmill.sources import readers, writers
from crawlmill.sources.buckets import BucketTable, TimeQueue
from crawlmill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _links(spark: SparkSession, sf_dir: str, sources=(L.HREF, L.ONCLICK, L.IMAGE)) -> DataFrame:
    return extract_links(
        X.enriched_pages(spark, sf_dir), X.SEARCH_DOMAINS, ("page_id",), sources
    )


def _page_links(spark: SparkSession, sf_dir: str, search_domains=X.SEARCH_DOMAINS) -> DataFrame:
    """Links to further pages: those in the markup and those of the tree."""
    keep, sources = ("page_id",), (L.HREF, L.ONCLICK)
    arrays = L.link_arrays(X.enriched_pages(spark, sf_dir), keep, sources)
    raw = L.raw_links(arrays, keep, sources).unionByName(X.tree_links(spark, sf_dir))
    return page_links(L.classified_links(raw, search_domains))


LINK_ORDER = ["page_id", "source", "pos"]


# --- sources, sinks and table maintenance ----------------------------------------

@query
def page_scan(spark, sf_dir):
    read = readers.read_pages(spark, f"{sf_dir}/pages.parquet")
    return read.select(
        "page_id", "url", F.length("html").cast("long").alias("n_chars"), F.md5("html").alias("html_md5")
    )


@query
def seed_frontier(spark, sf_dir):
    """Host roots as seeds; all frontier pages are done, so the frontier is empty."""
    seeds = X.sites(spark, sf_dir).select(
        F.col("id").alias("seed_order"),
        F.concat(F.lit("http://"), "domain", F.lit("/")).alias("url"),
    )
    queue = X.frontier(spark, sf_dir)
    done = X.frontier_pages(spark, sf_dir).select(F.col("id").alias("page_id"))
    return discovery.seed_frontier(
        seeds, FR.remove(queue, done), X.canonical_pages(spark, sf_dir), X.AS_OF
    )


@query
def site_scan(spark, sf_dir):
    return X.sites(spark, sf_dir).select(
        "id", "domain", F.coalesce("robots_content", F.lit("")).alias("robots_content")
    )


def _with_md5(rows: DataFrame, files: Payloads) -> DataFrame:
    """The MD5 of the payload that each row refers to; payloads are hashed where they are stored."""
    return rows.join(files.contents().select("digest", F.md5("data").alias("data_md5")), "digest")


@query
def binary_assets(spark, sf_dir):
    links = _links(spark, sf_dir, (L.HREF, L.ONCLICK))
    files = stage_files(X.link_files(spark, sf_dir))
    return _with_md5(assets.document_rows(links, files), files).select(
        "page_id", "url", "data_type_code", "n_bytes", "data_md5"
    )


@query
def image_assets(spark, sf_dir):
    links = _links(spark, sf_dir, (L.IMAGE,))
    files = stage_files(X.link_files(spark, sf_dir))
    return _with_md5(assets.image_rows(links, X.AS_OF, files), files).select(
        "page_id", "url", "filename", "content_type", "accessed_time", "n_bytes", "data_md5"
    )


@query
def rejected_rows(spark, sf_dir):
    """What the columns of a crawl database would keep out, with the reason."""
    step = discovery.discover(
        _page_links(spark, sf_dir), X.canonical_pages(spark, sf_dir), X.sites(spark, sf_dir),
        LINK_ORDER, X.AS_OF, COLUMN_LIMITS,
    )
    images = assets.image_rows(_links(spark, sf_dir, (L.IMAGE,)), X.AS_OF)
    return step.rejected.select(F.lit("page").alias("table_name"), "page_id", "url", "reason").unionByName(
        writers.rejected(images, "image", COLUMN_LIMITS).select(
            F.lit("image").alias("table_name"), "page_id", "url", "reason"
        )
    )


@query
def write_tables(spark, sf_dir):
    """What a crawl of all pages adds, written to the tables and read back.

    New sites and pages get dense ids behind the known ones; files are stored once by content.
    """
    known = X.canonical_pages(spark, sf_dir)
    given = materialize_all(
        links=_links(spark, sf_dir), site=X.sites(spark, sf_dir).select("id", "domain"),
        tree=page_links(L.classified_links(X.tree_links(spark, sf_dir), X.SEARCH_DOMAINS)),
    )
    links, sites = given["links"], given["site"]
    further = page_links(links).unionByName(given["tree"])
    found = materialize(discovery.discover(further, known, sites, LINK_ORDER, X.AS_OF).found, "found")
    step = discovery.Discovery(found, sites, X.AS_OF)
    site = T.with_surrogate_ids(step.new_sites(), ["domain"], sites.agg(F.max("id")).first()[0])
    last = known.agg(F.max("page_id")).first()[0]
    page = T.with_surrogate_ids(found.withColumnRenamed("page_id", "from_page"), ["from_page", "source", "pos"], last)
    by_domain = sites.unionByName(site).withColumnRenamed("id", "site_id")
    files = stage_files(X.link_files(spark, sf_dir))
    new = {
        "site": lambda: site,
        "page": lambda: page.join(by_domain, "domain").withColumn("page_type_code", F.lit("FRONTIER")),
        "frontier": lambda: page.select(F.col("id").alias("page_id"), ntz(X.AS_OF).alias("time_added"), F.lit(False).alias("occupied")),
        "link": lambda: page.select("from_page", F.col("id").alias("to_page")),
        "page_data": lambda: T.with_surrogate_ids(assets.document_rows(links, files), ["page_id", "url"]),
        "image": lambda: T.with_surrogate_ids(assets.image_rows(links, X.AS_OF, files), ["page_id", "url"]),
        "payload": files.contents,
    }

    def write(name: str) -> DataFrame:
        path = new_work_path(spark, name)
        writers.append_table(new[name](), name, path)
        return readers.read_table(spark, name, path)

    # The tables do not depend on each other, so their jobs run side by side.
    with ThreadPoolExecutor(len(new)) as jobs_:
        stored = dict(zip(new, jobs_.map(write, new)))
    return reduce(DataFrame.unionByName, [
        _rows("site", stored["site"], "id", "domain"),
        _rows("page", stored["page"], "id", "url", "site_id"),
        _rows("frontier", stored["frontier"], "page_id", "occupied"),
        _rows("link", stored["link"], "from_page", "to_page"),
        _rows("page_data", stored["page_data"], "page_id", "data_type_code", "digest"),
        _rows("image", stored["image"], "page_id", "filename", F.concat_ws(" ", "content_type", "digest")),
        _rows("payload", stored["payload"], "digest", F.length("data")),
    ])


def _page_snapshot(spark, sf_dir) -> DataFrame:
    """The page table before the batch: ``id, url, domain, type and status``."""
    old = X.responses(spark, sf_dir).select("page_id", "old_type", "old_status")
    return X.canonical_pages(spark, sf_dir).join(old, "page_id").select(
        F.col("page_id").alias("id"), "url", "domain",
        F.col("old_type").alias("page_type_code"),
        F.col("old_status").alias("http_status_code"),
    )


def _transitions(spark, sf_dir, final_dequeue=False) -> DataFrame:
    """Every third page counts as a copy, every page with id 3, 13, … as one without body."""
    page_id = F.col("page_id")
    return transitions.page_transitions(
        X.responses(spark, sf_dir).select(
            "page_id", "old_type", "old_status", "status",
            (page_id % 10 != 3).alias("has_body"), (page_id % 3 == 0).alias("is_dup"),
        ),
        final_dequeue,
    )


def _updated_pages(spark, sf_dir) -> DataFrame:
    return T.apply_updates(
        _page_snapshot(spark, sf_dir), _page_updates(spark, sf_dir), "id", ["page_type_code", "http_status_code"]
    )


def _page_updates(spark, sf_dir) -> DataFrame:
    return _transitions(spark, sf_dir).where(F.col("status").isNotNull()).select(
        F.col("page_id").alias("id"), "page_type_code", "http_status_code"
    )


@query
def apply_updates(spark, sf_dir):
    """The page table in buckets; those that have an updated page are exchanged."""
    pages = _page_snapshot(spark, sf_dir)
    table = BucketTable(spark, new_work_path(spark, "page"), pages.schema, "id").create(pages)
    table.update(_page_updates(spark, sf_dir), ["page_type_code", "http_status_code"])
    return table.read()


@query
def frontier_remove(spark, sf_dir):
    done = X.table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("page_id")
    )
    queue = X.frontier(spark, sf_dir)
    table = BucketTable(spark, new_work_path(spark, "frontier"), queue.schema, "page_id").create(queue)
    table.delete(done)
    return table.read()


@query
def code_tables(spark, sf_dir):
    """How often each code of the code tables is used."""
    types = _transitions(spark, sf_dir).select(
        F.lit("page_type").alias("code_table"), F.col("page_type_code").alias("code")
    )
    data = _links(spark, sf_dir, (L.HREF, L.ONCLICK)).where(F.col("cls") == L.DOCUMENT).select(
        F.lit("data_type").alias("code_table"),
        F.upper(F.substring_index("url", ".", -1)).alias("code"),
    )
    used = types.unionByName(data).groupBy("code_table", "code").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return T.code_tables(spark).join(used, ["code_table", "code"], "left").select(
        "code_table", "code", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


# --- URLs --------------------------------------------------------------------------

@query
def url_split(spark, sf_dir):
    url = F.col("url")
    return X.pages(spark, sf_dir).select(
        "page_id", url_scheme(url).alias("scheme"), url_netloc(url).alias("netloc"),
        url_path(url).alias("path"),
    )


@query
def url_scope(spark, sf_dir):
    netloc = url_netloc(F.col("url"))
    return X.pages(spark, sf_dir).select(
        "page_id", netloc.alias("netloc"), in_scope(netloc, X.SEARCH_DOMAINS).alias("in_scope")
    )


@query
def url_canonical(spark, sf_dir):
    keep = ("page_id",)
    raw = L.raw_links(
        L.link_arrays(X.enriched_pages(spark, sf_dir), keep, (L.HREF,)), keep, (L.HREF,)
    )
    return with_canonical_url(raw, "raw", "scheme", "host").select("page_id", "pos", "raw", "url")


@query
def url_site(spark, sf_dir):
    return X.canonical_pages(spark, sf_dir).select(
        "page_id", "url", site_of(F.col("url")).alias("domain")
    )


# --- extraction --------------------------------------------------------------------

@query
def html_body(spark, sf_dir):
    return L.page_bodies(X.pages(spark, sf_dir)).select("page_id", "body")


LINK_COLUMNS = ["page_id", "pos", "raw", "url", "cls"]


@query
def links_href(spark, sf_dir):
    return _links(spark, sf_dir, (L.HREF,)).select(LINK_COLUMNS)


@query
def links_onclick(spark, sf_dir):
    return _links(spark, sf_dir, (L.ONCLICK,)).select(LINK_COLUMNS)


@query
def links_img(spark, sf_dir):
    return _links(spark, sf_dir, (L.IMAGE,)).select(LINK_COLUMNS)


@query
def link_class(spark, sf_dir):
    return _links(spark, sf_dir).groupBy("source", "cls").agg(
        F.count(F.lit(1)).alias("n_links"), F.countDistinct("url").alias("n_urls")
    )


@query
def links_all(spark, sf_dir):
    links = page_links(_links(spark, sf_dir, (L.HREF, L.ONCLICK)))
    return links.select("page_id", "source", "pos", "url")


# --- discovery ---------------------------------------------------------------------

@query
def first_discovery(spark, sf_dir):
    return discovery.first_discovery(_page_links(spark, sf_dir), LINK_ORDER).select(
        "url", "page_id", "from_url", "source", "pos"
    )


@query
def unseen_urls(spark, sf_dir):
    """Most new URLs are cleared by a bitmap of the known ones; the others meet these."""
    targets = _page_links(spark, sf_dir).select("url").distinct()
    known = materialize(X.canonical_pages(spark, sf_dir).select("url"), "known-urls")
    return unseen_by_index(targets, UrlIndex.of(known), known).rows


@query
def new_sites(spark, sf_dir):
    found = _page_links(spark, sf_dir).select(site_of(F.col("url")).alias("domain"))
    return discovery.new_sites(found, X.sites(spark, sf_dir))


def _discovery(spark, sf_dir) -> discovery.Discovery:
    return discovery.discover(
        _page_links(spark, sf_dir), X.canonical_pages(spark, sf_dir),
        X.sites(spark, sf_dir), LINK_ORDER, X.AS_OF,
    )


@query
def discovery_links(spark, sf_dir):
    return _discovery(spark, sf_dir).new_links()


def _rows(name: str, df: DataFrame, *columns: Column | str) -> DataFrame:
    """Rows of one table in the common form ``table_name, k1, k2, k3``."""
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    values += [F.lit("")] * (3 - len(values))
    return df.select(
        F.lit(name).alias("table_name"),
        *[F.coalesce(v, F.lit("")).alias(f"k{i}") for i, v in enumerate(values, 1)],
    )


def _discovery_rows(step: discovery.Discovery) -> list[DataFrame]:
    return [
        _rows("site", step.new_sites(), "domain"),
        _rows("page", step.new_pages(), "url", "domain", "page_type_code"),
        _rows("frontier", step.new_frontier(), "url", "occupied"),
        _rows("link", step.new_links(), "from_url", "to_url"),
    ]


@query
def discover(spark, sf_dir):
    """The whole compound step; the found URLs are written once and feed four tables."""
    step = _discovery(spark, sf_dir)
    step = discovery.Discovery(materialize(step.found, "found"), step.sites, step.as_of)
    return reduce(DataFrame.unionByName, _discovery_rows(step))


def _page_ids(spark, sf_dir) -> DataFrame:
    """Page id by canonical URL, written once; the first page has the URL."""
    return materialize(
        X.canonical_pages(spark, sf_dir).groupBy("url").agg(F.min("page_id").alias("id")),
        "page-ids",
    )


@query
def page_by_url(spark, sf_dir):
    links = _page_links(spark, sf_dir).select("page_id", "url")
    return discovery.pages_by_url(links, _page_ids(spark, sf_dir)).select(
        "page_id", "url", "target_id"
    )


@query
def new_links(spark, sf_dir):
    """All links between pages; those down the tree are stored already."""
    candidates = page_by_url(spark, sf_dir).select(
        F.col("page_id").alias("from_page"), F.col("target_id").alias("to_page")
    )
    stored = X.tree_edges(spark, sf_dir).where(F.col("dst") > F.col("src")).select(
        F.col("src").alias("from_page"), F.col("dst").alias("to_page")
    )
    return discovery.new_links(candidates, stored)


@query
def link_graph(spark, sf_dir):
    pages = X.canonical_pages(spark, sf_dir)
    own = pages.select("page_id", F.col("url").alias("own_url"))
    links = _page_links(spark, sf_dir).join(own, "page_id").select(
        F.col("own_url").alias("from_url"), "url"
    )
    return reports.degrees(reports.link_graph(links, pages))


# --- content -----------------------------------------------------------------------

def _hashed_documents(spark, sf_dir) -> DataFrame:
    """Ids and hashes, written once: the texts are read and hashed a single time."""
    hashed = X.documents(spark, sf_dir).select(
        "id", H.content_hash(F.col("text")).alias("content_hash")
    )
    return materialize(hashed, "hashes")


@query
def content_hash(spark, sf_dir):
    """Pages in five spellings of their markup; the hash is that of the page as given."""
    return X.respelled_pages(spark, sf_dir).select(
        "page_id", H.content_hash(F.col("html")).alias("content_hash")
    )


@query
def content_dup(spark, sf_dir):
    return content.content_verdicts(_hashed_documents(spark, sf_dir))


@query
def content_dup_semi(spark, sf_dir):
    documents = _hashed_documents(spark, sf_dir)
    return content.seen_elsewhere(documents, documents).select("id")


# --- robots and politeness -----------------------------------------------------------

def _states(spark, sf_dir) -> DataFrame:
    """State of every site, written once as a crawl keeps it."""
    current = R.with_current_robots(X.sites(spark, sf_dir), X.fetched_robots(spark, sf_dir))
    return materialize(R.site_states(current), "states")


def _decisions(spark, sf_dir) -> DataFrame:
    return R.fetch_decisions(
        X.canonical_pages(spark, sf_dir).select("page_id", "url", "domain"),
        _states(spark, sf_dir), X.AS_OF,
    )


@query
def robots_rules(spark, sf_dir):
    return R.robots_rules(X.sites(spark, sf_dir))


@query
def crawl_delay(spark, sf_dir):
    return R.robots_policies(X.sites(spark, sf_dir)).select("domain", "delay")


@query
def robots_verdict(spark, sf_dir):
    urls = X.canonical_pages(spark, sf_dir).select("page_id", "url", "domain")
    policies = materialize(R.robots_policies(X.sites(spark, sf_dir)), "policies")
    return R.robots_verdicts(urls, policies).select("page_id", "url", "allowed")


@query
def fetch_decision(spark, sf_dir):
    return _decisions(spark, sf_dir).select("page_id", "url", "domain", "decision")


@query
def site_update(spark, sf_dir):
    return R.site_update(_decisions(spark, sf_dir), X.AS_OF)


@query
def apply_forbidden(spark, sf_dir):
    """Pages after the decisions, and whether they are still in the frontier."""
    forbidden = materialize(transitions.forbid(_decisions(spark, sf_dir), X.AS_OF), "forbidden")
    before = _page_snapshot(spark, sf_dir).withColumn("accessed_time", F.lit(None).cast("timestamp_ntz"))
    after = T.apply_updates(
        before, forbidden.withColumnRenamed("page_id", "id"), "id",
        ["page_type_code", "http_status_code", "accessed_time"],
    )
    queue = FR.remove(before.select(F.col("id").alias("page_id")), forbidden)
    queued = queue.select(F.col("page_id").alias("id"), F.lit(True).alias("_queued"))
    return after.join(queued, "id", "left").select(
        "id", "page_type_code", "http_status_code", "accessed_time",
        F.coalesce("_queued", F.lit(False)).alias("queued"),
    )


@query
def sitemap_url(spark, sf_dir):
    return X.sites(spark, sf_dir).select(
        "domain", R.sitemap_url(F.col("robots_content")).alias("sitemap_url")
    ).where(F.col("sitemap_url").isNotNull())


@query
def sitemap_locs(spark, sf_dir):
    return R.sitemap_locs(X.sitemaps(spark, sf_dir), ("domain", "block"))


@query
def sitemap_frontier(spark, sf_dir):
    """Sitemap pages that no page of the corpus links to."""
    known = page_links(_links(spark, sf_dir, (L.HREF, L.ONCLICK)))
    return R.sitemap_frontier(
        X.sitemaps(spark, sf_dir), known, X.AS_OF, X.SEARCH_DOMAINS, ("domain", "block"),
    ).drop("block", "pos")


# --- frontier ----------------------------------------------------------------------

def _ready(spark, sf_dir) -> DataFrame:
    return FR.ready_pages(
        X.frontier(spark, sf_dir), X.frontier_pages(spark, sf_dir),
        X.frontier_sites(spark, sf_dir), X.AS_OF,
    )


@query
def frontier_ready(spark, sf_dir):
    return _ready(spark, sf_dir).select("page_id", "site_id", "time_added")


@query
def frontier_pop(spark, sf_dir):
    """The oldest ready row, from a queue that lies in folders by day."""
    queue = X.frontier(spark, sf_dir)
    days = TimeQueue(spark, new_work_path(spark, "queue"), queue.schema, "time_added").create(queue)
    pages, sites = X.frontier_pages(spark, sf_dir), X.frontier_sites(spark, sf_dir)
    oldest = days.oldest(lambda rows: FR.next_pages(FR.ready_pages(rows, pages, sites, X.AS_OF)))
    return oldest.select("page_id", "site_id", "time_added")


@query
def frontier_occupy(spark, sf_dir):
    return FR.occupy(X.frontier(spark, sf_dir), FR.next_pages(_ready(spark, sf_dir)))


@query
def frontier_batch(spark, sf_dir):
    return FR.next_batch(_ready(spark, sf_dir), 3).select("page_id", "site_id", "site_rank")


@query
def frontier_reset(spark, sf_dir):
    return FR.release(X.frontier(spark, sf_dir))


@query
def frontier_give_back(spark, sf_dir):
    """Occupied rows whose site is not open yet are free again."""
    late = X.frontier_sites(spark, sf_dir).where(
        F.col("next_acces") > F.lit(X.AS_OF.isoformat(" ")).cast("timestamp_ntz")
    ).select(F.col("id").alias("site_id"))
    delayed = X.frontier_pages(spark, sf_dir).join(late, "site_id", "left_semi").select(
        F.col("id").alias("page_id")
    )
    return FR.give_back(X.frontier(spark, sf_dir), delayed)


@query
def frontier_requeue(spark, sf_dir):
    again = X.frontier(spark, sf_dir).where(F.col("occupied")).select("page_id")
    return FR.requeue(X.frontier(spark, sf_dir), again, X.AS_OF)


def _queued(spark, sf_dir) -> DataFrame:
    return X.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"), F.col("user_id").alias("site_id"),
        F.col("ts").alias("time_added"),
    )


@query
def fetch_schedule(spark, sf_dir):
    return FR.fetch_schedule(
        _queued(spark, sf_dir), X.frontier_sites(spark, sf_dir), X.AS_OF
    ).select("page_id", "site_id", "site_rank", "fetch_time")


@query
def fetch_schedule_split(spark, sf_dir):
    """The schedule of the rows that are free."""
    free = _queued(spark, sf_dir).join(
        X.frontier(spark, sf_dir).where(~F.col("occupied")).select("page_id"), "page_id", "left_semi"
    )
    return FR.fetch_schedule(free, X.frontier_sites(spark, sf_dir), X.AS_OF).select(
        "page_id", "site_id", "site_rank", "fetch_time"
    )


# --- page state ----------------------------------------------------------------------

@query
def page_state(spark, sf_dir):
    return X.pages(spark, sf_dir).select(
        "page_id",
        F.coalesce(
            transitions.page_state(X.status_of(F.col("page_id"))), F.lit("no response")
        ).alias("state"),
    )


@query
def page_transition(spark, sf_dir):
    """Documents as pages: bodies and copies are found in their markup, which has several spellings."""
    keep = ("page_id", "old_type", "old_status")
    features = page_features(X.document_responses(spark, sf_dir), keep).select(*keep, "status", "has_body", "content_hash")
    verdicts = content.content_verdicts(materialize(features, "features"), ("page_id",), key="page_id")
    judged = verdicts.withColumn("is_dup", F.col("page_type_code") == "DUPLICATE")
    final = transitions.page_transitions(judged, final_dequeue=True).select(
        "page_id", F.col("requeue").alias("requeue_final")
    )
    return transitions.page_transitions(judged).join(final, "page_id").select(
        "page_id", "page_type_code", "http_status_code", "requeue", "requeue_final",
        "store_content",
    )


@query
def process_batch(spark, sf_dir):
    """One step over all pages; one row per changed row of any table."""
    result = run_batch(
        X.canonical_responses(spark, sf_dir), X.canonical_pages(spark, sf_dir), X.sites(spark, sf_dir),
        None, X.AS_OF, X.SEARCH_DOMAINS, files=stage_files(X.link_files(spark, sf_dir)),
    )
    frames = [
        _rows("updated_page", result.pages, "page_id", "page_type_code", "http_status_code"),
        _rows("content", result.contents(), "page_id", F.md5("html_content")),
        _rows("hash", result.pages, "page_id", "content_hash"),
        _rows("removed", result.frontier_removed(), "page_id"),
        _rows("page_data", result.documents, "page_id", "data_type_code", "digest"),
        _rows("image", result.images, "page_id", "filename", "content_type"),
        *_discovery_rows(result.discovery),
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def fk_violations(spark, sf_dir):
    """Checks over derived tables, some of which point at rows that do not exist."""
    links = materialize(_links(spark, sf_dir).select("page_id", "url", "cls"), "links")
    page = _updated_pages(spark, sf_dir).join(
        X.sites(spark, sf_dir).select(F.col("id").alias("site_id"), "domain"), "domain"
    )
    codes = T.code_tables(spark)
    return T.fk_violations({
        "page": page,
        "site": X.sites(spark, sf_dir),
        "page_type": codes.where(F.col("code_table") == "page_type"),
        "data_type": codes.where(F.col("code_table") == "data_type"),
        "page_data": links.where(F.col("cls") == L.DOCUMENT).select(
            "page_id", F.upper(F.substring_index("url", ".", -1)).alias("data_type_code")
        ),
        "image": links.where(F.col("cls") == L.PICTURE).select("page_id"),
        "frontier": X.frontier(spark, sf_dir),
        "link": X.tree_edges(spark, sf_dir).select(
            F.col("src").alias("from_page"), (F.col("dst") + 1).alias("to_page")
        ),
    })


@query
def crawl_report(spark, sf_dir):
    pages = _updated_pages(spark, sf_dir)
    return reports.crawl_report(pages).select(
        F.coalesce("domain", F.lit("all")).alias("domain"),
        F.coalesce("page_type_code", F.lit("all")).alias("page_type_code"),
        F.coalesce(F.col("http_status_code").cast("string"), F.lit("all or none")).alias("status"),
        "level", "n_pages",
    )


# --- iteration and streams -------------------------------------------------------------

def _corpus_edges(spark, sf_dir) -> DataFrame:
    """Page links to any host, by the canonical URL of the linking page."""
    own = X.canonical_pages(spark, sf_dir).select("page_id", F.col("url").alias("own_url"))
    links = _page_links(spark, sf_dir, ())
    return links.join(own, "page_id").select(
        F.col("own_url").alias("from_url"), "url", "page_id", "source", "pos"
    )


@query
def bfs_levels(spark, sf_dir):
    """Levels of everything reachable from the first page of every host."""
    edges = _corpus_edges(spark, sf_dir)
    first = X.sites(spark, sf_dir).select(F.col("id").alias("page_id"))
    seeds = X.canonical_pages(spark, sf_dir).join(first, "page_id", "left_semi").select(
        "url", F.col("page_id").alias("seed_order")
    )
    return search_levels(edges, seeds, ("page_id", "source", "pos")).select("url", "level")


def _replay(spark, sf_dir) -> Replay:
    """A whole crawl from the host roots, with robots, sitemaps, errors and copies."""
    sites = X.sites(spark, sf_dir).select("id", "domain", "robots_content")
    located = sites.drop("id").join(
        X.sitemaps(spark, sf_dir).select("domain", "sitemap_content"), "domain"
    )
    corpus = prepare_corpus(
        X.responses(spark, sf_dir).select("page_id", "url", "html", "status"),
        located, X.SEARCH_DOMAINS,
    )
    own = X.canonical_pages(spark, sf_dir).select("page_id", F.col("url").alias("own_url"))
    tree = page_links(L.classified_links(X.tree_links(spark, sf_dir), X.SEARCH_DOMAINS))
    tree = tree.join(own, "page_id").select(F.col("own_url").alias("from_url"), "source", "pos", "url")
    corpus = replace(
        corpus, links=materialize(corpus.links.unionByName(tree), "links-with-tree")
    )
    seeds = sites.select(
        F.concat(F.lit("http://"), "domain", F.lit("/")).alias("url"),
        F.col("id").alias("seed_order"),
    )
    return replay(corpus, seeds)


@query
def crawl_replay(spark, sf_dir):
    return _replay(spark, sf_dir).pages.select(
        "url", "domain", "page_type_code", "http_status_code", "round"
    )


@query
def crawl_replay_links(spark, sf_dir):
    """The discovery links of the same crawl; they depend on the order of the queue."""
    return _replay(spark, sf_dir).links


@query
def crawl_round(spark, sf_dir):
    """One round through the table versions, seeded with all pages of the corpus."""
    seeds = X.canonical_pages(spark, sf_dir).select(F.col("page_id").alias("seed_order"), "url")
    robots = X.sites(spark, sf_dir).select("domain", "robots_content", "sitemap_content")
    corpus = X.responses(spark, sf_dir).select("page_id", "status", "html").join(
        _page_ids(spark, sf_dir).select(F.col("id").alias("page_id"), "url"), "page_id"
    ).drop("page_id")
    db = CrawlDb.create(spark, new_work_path(spark, "crawl")).start(seeds, X.AS_OF)
    db, todo = db.select(X.AS_OF, 5, robots, X.SEARCH_DOMAINS)
    got = todo.join(corpus, "url", "left")
    db = db.apply(got, X.AS_OF, X.SEARCH_DOMAINS)
    return db.table("page").select("id", "site_id", "url", "page_type_code", "http_status_code")


def _in_thirds(spark, rows: DataFrame, key: Column, run: Callable[[DataFrame, int], StreamingQuery]) -> None:
    """Let the rows arrive in three parts by their key, and run the stream after each: three micro-batches."""
    folder = new_work_path(spark, "arrivals")
    rows = materialize(rows.withColumn("_key", key), "arriving")
    ends = rows.agg(F.min("_key").alias("low"), F.max("_key").alias("high")).first()
    low, span = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0)
    third = X.third_of(F.col("_key"), low, span)
    for number in range(3):
        rows.where(third == number).drop("_key").write.mode("append").parquet(folder)
        arrived = readers.page_stream(spark, folder, schema=rows.drop("_key").schema)
        run(arrived, number).awaitTermination()


@query
def stream_new_urls(spark, sf_dir):
    root = new_work_path(spark, "new-urls")
    _in_thirds(
        spark, X.pages(spark, sf_dir), F.col("page_id"),
        lambda pages, _: jobs.new_url_stream(pages, root, X.SEARCH_DOMAINS),
    )
    return jobs.read_batches(spark, f"{root}/urls").select("url")


@query
def stream_content_dup(spark, sf_dir):
    root = new_work_path(spark, "contents")
    hashed = X.documents(spark, sf_dir).select("id", H.content_hash(F.col("text")).alias("content_hash"))
    _in_thirds(spark, hashed, F.col("id"), lambda contents, _: jobs.content_stream(contents, root))
    return jobs.read_batches(spark, f"{root}/verdicts").select("id", "content_hash", "page_type_code")


@query
def stream_schedule(spark, sf_dir):
    """URLs by their time; every fourth site has a row only from the second part on."""
    root = new_work_path(spark, "schedule")
    sites = lambda session: X.frontier_sites(session, sf_dir)
    first = lambda session: sites(session).where(~X.comes_later(F.col("id")))
    _in_thirds(
        spark, _queued(spark, sf_dir), F.unix_micros(F.col("time_added").cast("timestamp")),
        lambda urls, number: jobs.schedule_stream(urls, sites if number else first, X.AS_OF, root),
    )
    return jobs.read_batches(spark, f"{root}/schedule").select(
        "page_id", "site_id", "site_rank", "fetch_time"
    )
