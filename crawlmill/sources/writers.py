"""Outputs: appends, snapshots and bucketed tables, with optional length limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill import limits as S
from crawlmill.limits import NO_LIMITS, Limits
from crawlmill.schemas import TABLES

# The columns of each table that can be limited, and the limit that holds for them.
_LIMITED = {
    "site": {"domain": "domain"},
    "page": {"url": "url", "page_type_code": "code"},
    "page_data": {"data_type_code": "code"},
    "image": {"filename": "filename", "content_type": "content_type"},
    "payload": {},
    "link": {},
    "frontier": {},
}


def _texts(name: str, limits: Limits) -> dict[str, tuple[Column, int | None]]:
    return {c: (F.col(c), getattr(limits, limit)) for c, limit in _LIMITED[name].items()}


def accepted(df: DataFrame, name: str, limits: Limits = NO_LIMITS) -> DataFrame:
    """Rows whose texts fit the columns of the table."""
    return S.fitting(df, _texts(name, limits))


def rejected(df: DataFrame, name: str, limits: Limits = NO_LIMITS) -> DataFrame:
    """Rows that do not fit and are not stored, with ``reason``."""
    return S.rejected(df, _texts(name, limits))


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in order and type; missing ones are NULL."""
    return df.select(*[
        (F.col(field.name) if field.name in df.columns else F.lit(None))
        .cast(field.dataType).alias(field.name)
        for field in TABLES[name].fields
    ])


def append_table(df: DataFrame, name: str, path: str, limits: Limits = NO_LIMITS) -> None:
    """Add the acceptable rows of ``df`` to the table at ``path``."""
    conform(accepted(df, name, limits), name).write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, name: str, path: str, limits: Limits = NO_LIMITS) -> None:
    """Write a whole new version of a table; the path must not exist yet."""
    conform(accepted(df, name, limits), name).write.mode("errorifexists").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, path: str, partition: str | None = None
) -> None:
    """Add to a table clustered by its join key; the first call makes it.

    Joins and groupings by that key then read it without a shuffle. Use it for what is
    joined again and again: edges by ``from_url``, pages by ``url``. A ``partition`` column keeps
    what is added apart. Rows go to the task of their bucket first, so that each call adds one file
    for a bucket and not one for every task and bucket.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("append")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
