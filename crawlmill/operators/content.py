"""Content duplicates: who was first with a content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmill.session import materialize


def first_holders(pages: DataFrame, order: Sequence[str], key: str = "id") -> DataFrame:
    """Per content hash the id of the first page (``order``, then ``key``).

    A plain aggregation: each task reduces a hash to one row before the shuffle, so the
    size of a group of copies does not matter.
    """
    hashed = pages.where(F.col("content_hash").isNotNull())
    columns = [c for c in order if c != key] + [key]
    if len(columns) == 1:
        return hashed.groupBy("content_hash").agg(F.min(key).alias(key))
    first = F.min(F.struct(*columns)).alias("_first")
    return (
        hashed.groupBy("content_hash").agg(first)
        .select("content_hash", F.col(f"_first.{key}").alias(key))
    )


def content_verdicts(
    pages: DataFrame,
    order: Sequence[str] = (),
    known_hashes: DataFrame | None = None,
    key: str = "id",
) -> DataFrame:
    """Add ``page_type_code``: HTML for the first page of a content, else DUPLICATE.

    ``known_hashes`` are contents stored before, with the id of their page in ``key``: a
    page that is visited again is no duplicate of itself. Without that column they belong
    to other pages. Pages without a hash get NULL. Only ids and hashes are shuffled, and the
    way back to the pages is a join on the unique page id, so no group of copies ever meets
    in one task.
    """
    fresh = pages if known_hashes is None else _not_held_elsewhere(pages, known_hashes, key)
    first = first_holders(fresh, order, key).select(key, F.lit(True).alias("_first"))
    verdict = F.when(
        F.col("content_hash").isNotNull(),
        F.when(F.col("_first"), "HTML").otherwise("DUPLICATE"),
    )
    return (
        pages.join(first, key, "left")
        .withColumn("page_type_code", verdict)
        .drop("_first")
    )


def _hash_ends(stored: DataFrame, key: str) -> DataFrame:
    """The least and the greatest id of each hash."""
    return stored.where(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(
        F.min(key).alias("_least"), F.max(key).alias("_greatest")
    )


def _not_held_elsewhere(pages: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Ids and hashes of the pages whose hash no other stored page has."""
    if key not in known.columns:
        return pages.join(known.select("content_hash"), "content_hash", "left_anti")
    ends = _hash_ends(known, key)
    other = (pages[key] != ends["_least"]) | (pages[key] != ends["_greatest"])
    return pages.join(ends, (pages["content_hash"] == ends["content_hash"]) & other, "left_anti")


def seen_elsewhere(pages: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Pages for which a stored page with the same hash and another id exists.

    Two ids per hash (the least and the greatest) decide that for every page, so the
    stored side shrinks to one row per hash. It is written before it is joined: the join
    then reads a plain shuffle on both sides, which is what Spark can split where many
    pages share a hash, and its measured size decides about a broadcast.
    """
    ends = materialize(_hash_ends(stored, key), "hash-ends")
    other = (pages[key] != ends["_least"]) | (pages[key] != ends["_greatest"])
    return pages.join(
        ends, (pages["content_hash"] == ends["content_hash"]) & other, "left_semi"
    )
