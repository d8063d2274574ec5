"""Table schemas of the crawl database."""

from __future__ import annotations

from pyspark.sql import types as T

SITE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("domain", T.StringType()),
    T.StructField("robots_content", T.StringType()),
    T.StructField("sitemap_content", T.StringType()),
    T.StructField("next_acces", T.TimestampNTZType()),
    T.StructField("delay", T.IntegerType()),
])

PAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("site_id", T.LongType()),
    T.StructField("page_type_code", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("html_content", T.StringType()),
    T.StructField("http_status_code", T.IntegerType()),
    T.StructField("accessed_time", T.TimestampNTZType()),
    T.StructField("content_hash", T.StringType()),
])

PAGE_DATA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("data_type_code", T.StringType()),
    T.StructField("digest", T.StringType()),
])

IMAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("digest", T.StringType()),
    T.StructField("accessed_time", T.TimestampNTZType()),
])

# Files by content: page_data and image refer to them by digest.
PAYLOAD = T.StructType([
    T.StructField("digest", T.StringType()),
    T.StructField("data", T.BinaryType()),
])

LINK = T.StructType([
    T.StructField("from_page", T.LongType()),
    T.StructField("to_page", T.LongType()),
])

FRONTIER = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("time_added", T.TimestampNTZType()),
    T.StructField("occupied", T.BooleanType()),
])

TABLES = {
    "site": SITE,
    "page": PAGE,
    "page_data": PAGE_DATA,
    "image": IMAGE,
    "payload": PAYLOAD,
    "link": LINK,
    "frontier": FRONTIER,
}

# Input corpus: one row per fetched page.
FETCHED_PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
