"""Best-fit packing of documents into sequences, with conflicts.

Bins are kept in the order of their residual room and carry bitmaps of the sources and duplicate
clusters they hold. A piece goes to the tightest bin that has room and shares neither source nor
cluster with it: the search starts at the smallest sufficient residual and goes on to the next
larger one until a compatible bin is found; if none is, a bin is opened.

Best-fit needs to see bins one after the other, so pieces are dealt by a hash of their id to shards
of about ``SHARD`` pieces, and each shard is packed alone. The number of shards follows the number of
pieces; a source or cluster of any size is spread over all of them.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.session import materialize

CAPACITY = 2048
SHARD = 4096


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")).cast("long")


def text_cluster(text: Column) -> Column:
    """Digest that texts share if they differ in case and blanks only."""
    return F.md5(F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))))


def _bits(values: Sequence) -> list[int]:
    """One bit for each distinct value; a null has none, so it conflicts with nothing."""
    places: dict = {}
    return [0 if v is None else 1 << places.setdefault(v, len(places)) for v in values]


def best_fit(lengths: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, taken in the given order. No length exceeds the capacity."""
    room: list[tuple[int, int]] = []  # (residual, bin), ordered
    held: list[tuple[int, int]] = []  # bitmaps of sources and clusters, by bin
    places = []
    for length, source, cluster in zip(lengths, _bits(sources), _bits(clusters)):
        at = bisect_left(room, (length, -1))
        while at < len(room):
            has_sources, has_clusters = held[room[at][1]]
            if not (has_sources & source or has_clusters & cluster):
                break
            at += 1
        if at < len(room):
            residual, chosen = room.pop(at)
            held[chosen] = has_sources | source, has_clusters | cluster
        else:
            residual, chosen = capacity, len(held)
            held.append((source, cluster))
        places.append((chosen, capacity - residual))
        if residual > length:
            insort(room, (residual - length, chosen))
    return places


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    length_col: str = "n_words",
    source_col: str = "source",
    cluster_col: str = "cluster",
    shard: int = SHARD,
) -> DataFrame:
    """One row per piece: id, source, piece, start, length, bin_id, offset.

    A document longer than the capacity is cut into full pieces and a rest; ``start`` is where the
    piece begins in the document, ``offset`` where it lies in its bin. Inside a shard longer pieces
    come first, ties by id and piece. Null sources and clusters conflict with nothing. Documents
    without words (or with a null length) have one piece of length 0 in no bin. Repeated rows are
    packed once each. Only the four named columns are read; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.greatest(F.coalesce(F.col(length_col), F.lit(0)), F.lit(0)).cast("long").alias("total"),
        F.col(source_col).alias("source"),
        F.col(cluster_col).alias("cluster"),
    )
    last = F.greatest(F.ceil(F.col("total") / capacity), F.lit(1).cast("long")) - 1
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("start", F.col("piece") * capacity)
    pieces = materialize(
        pieces.select("id", "source", "cluster", "piece", "start", F.least(F.col("total") - F.col("start"), F.lit(capacity)).alias("length")),
        "pieces",
    )
    filled = pieces.filter("length > 0")
    shards = max(1, -(-filled.count() // shard))
    dealt = filled.withColumn("shard", F.pmod(F.xxhash64("id", "piece"), F.lit(shards)))
    kind = docs.schema[id_col].dataType.simpleString(), docs.schema[source_col].dataType.simpleString()
    schema = f"id {kind[0]}, source {kind[1]}, piece long, start long, length long, bin_id long, offset long"

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending")])
        lists = [rows.column(c).to_pylist() for c in ("length", "source", "cluster")]
        places = best_fit(*lists, capacity)
        first = rows.column("shard")[0].as_py() << 32
        return rows.select(["id", "source", "piece", "start", "length"]).append_column(
            "bin_id", pa.array([first + b for b, _ in places], pa.int64())
        ).append_column("offset", pa.array([o for _, o in places], pa.int64()))

    packed = dealt.groupBy("shard").applyInArrow(run, schema)
    empty = pieces.filter("length = 0").select(
        "id", "source", "piece", "start", "length", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("offset")
    )
    return packed.unionByName(empty).withColumnsRenamed({"id": id_col, "source": source_col, "length": length_col})
