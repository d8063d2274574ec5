"""A bitmap of known URLs, asked before the exact join.

A URL sets one bit by its hash. A candidate whose bit is not set is new for certain and meets no other row; the
rest, the known ones and a few clashes, go through the exact anti join. The bitmap is a table of pieces of 32,768
bits, built by bitmap aggregates, which merge on the map side. It is broadcast, and its size is chosen and
bounded beforehand: at most 64 MB. With more URLs than a quarter of its bits it would clear little, and
all candidates take the exact join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.operators.discovery import unseen_urls
from crawlmill.session import materialize

BITS_PER_URL = 16
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 29  # 4 KB to 64 MB


def _bits_for(urls: int) -> int:
    """A power of two with enough bits for so many URLs, within the bounds."""
    return min(max(LEAST_BITS, 1 << (max(1, urls * BITS_PER_URL) - 1).bit_length()), MOST_BITS)


@dataclass(frozen=True)
class UrlIndex:
    """``pieces(piece, bits)`` of a bitmap with ``slots`` bits, and how many URLs it was given."""

    pieces: DataFrame
    slots: int
    urls: int

    @classmethod
    def of(cls, known: DataFrame, expected: int | None = None) -> UrlIndex:
        """The index of ``known(url)``; ``expected`` is the number of URLs it should have room for."""
        urls = known.count()
        slots = _bits_for(max(urls, expected or 0))
        return cls(materialize(_pieces(known, slots), "url-bits"), slots, urls)

    def with_urls(self, new: DataFrame) -> UrlIndex:
        """The index with more URLs; nothing known is read again."""
        both = self.pieces.unionByName(_pieces(new, self.slots))
        merged = both.groupBy("piece").agg(F.bitmap_or_agg("bits").alias("bits"))
        return UrlIndex(materialize(merged, "url-bits"), self.slots, self.urls + new.count())

    def is_useful(self) -> bool:
        return self.urls * 4 <= self.slots

    def marked(self, candidates: DataFrame) -> DataFrame:
        """Candidates with ``_new``: true if the URL is not known for certain."""
        slot = _slot(self.slots)
        place = F.bitmap_bit_position(slot)
        pieces = self.pieces.withColumnRenamed("piece", "_piece").withColumnRenamed("bits", "_bits")
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        known = F.bit_get(byte, (place % 8).cast("int")) == 1
        joined = candidates.join(F.broadcast(pieces), F.bitmap_bucket_number(slot) == F.col("_piece"), "left")
        return joined.withColumn("_new", ~F.coalesce(known, F.lit(False))).drop("_piece", "_bits")


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(slots)) + 1


def _pieces(urls: DataFrame, slots: int) -> DataFrame:
    slot = _slot(slots)
    return urls.where(F.col("url").isNotNull()).groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )


@dataclass(frozen=True)
class Unseen:
    """The candidates that are not known, and how many of all the bitmap cleared."""

    rows: DataFrame
    candidates: int
    cleared: int


def unseen_by_index(candidates: DataFrame, index: UrlIndex, known: DataFrame) -> Unseen:
    """Candidates whose URL is not in ``known``, which the index is of."""
    if not index.is_useful():
        return Unseen(unseen_urls(candidates, known), candidates.count(), 0)
    marked = materialize(index.marked(candidates), "marked-urls")
    counts = marked.agg(F.count(F.lit(1)).alias("n"), F.count_if("_new").alias("new")).first()
    asked = marked.where(~F.col("_new")).drop("_new")
    rows = marked.where("_new").drop("_new").unionByName(unseen_urls(asked, known))
    return Unseen(rows, counts["n"], counts["new"])
