"""Exact de-duplication with skew-safe combining.

Copies are combined three times: inside each input partition (the map side of the first
aggregation), inside each salt of a digest, and among the salts of a digest. Digest and whole text
are grouping keys each time, so rows are equal only if their contents are. A text sends at most one
row per input partition to the first shuffle and one row per salt to the second, whatever the
number of its copies.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.llm.common import text_or_empty
from crawlmill.session import materialize

SALTS = 16


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _combined(rows: DataFrame, best: Column, salts: int) -> DataFrame:
    """One row per text (digest, text, best, n) from rows with text and digest."""
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    merged = salted.groupBy("digest", "salt", "text").agg(best.alias("best"), F.count("*").alias("n"))
    return (
        merged.select("digest", "text", "best", "n")
        .repartition("digest")
        .groupBy("digest", "text")
        .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = _sha256,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Rows with the same text are a group; its largest id stays. A null text counts as empty. Null
    ids are smaller than all others. Rows that repeat an id with the same text are the same document
    and marked alike. Other columns, whatever their names, are not read. An empty table gives an
    empty result.

    Documents find their group by digest alone where a digest has one text. Documents of digests
    with several texts are compared by text. The groups (no texts) are written to the shared folder.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    groups = materialize(
        _combined(rows, F.max("id"), salts)
        .groupBy("digest")
        .agg(F.max("best").alias("keep_id"), F.max("n").alias("group_size"), F.count("*").alias("texts")),
        "exact_groups",
    )
    keyed = rows.select("id", "digest", F.sha2("text", 256).alias("text_sha256"))
    found = keyed.join(groups.filter("texts = 1").drop("texts"), "digest")
    shared = groups.filter("texts > 1").select("digest")
    if not shared.isEmpty():
        several = rows.join(shared, "digest", "left_semi")
        texts = _combined(several, F.max("id"), salts).withColumnsRenamed({"best": "keep_id", "n": "group_size"})
        found = found.unionByName(
            several.withColumn("text_sha256", F.sha2("text", 256)).join(texts, ["digest", "text"]).drop("text")
        )
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with all their columns.

    Of rows that repeat the largest id with the same text, the one with the largest other columns
    stays (these must be orderable). The text itself is a grouping key and travels twice.
    """
    others: Sequence[str] = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), F.col(text_col).isNotNull().alias("given"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)]).alias("row"),
        text_or_empty(text_col).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    kept = _combined(rows, F.max("row"), salts)
    back = {id_col: F.col("best.id"), text_col: F.when(F.col("best.given"), F.col("text"))}
    back |= {c: F.col(f"best.c{i}") for i, c in enumerate(others)}
    return kept.select(*[back[c].alias(c) for c in docs.columns])
