"""Wide contents: written once, chosen late, and read back by their place.

A place is a file and a row in it. Which contents are wanted is decided on narrow rows. The decision
comes back to the contents as one bit for each row of a file: files without a wanted row are not read,
and the others meet their bits in a broadcast whose size is checked. No content passes a shuffle,
however many rows are wanted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.session import materialize

#: Words of 64 rows whose bits are broadcast at once: 32 MB, or 268 million rows. More rows are read in turns.
WORDS = 1 << 22
_WORD = 64


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]


def _turns(sizes: Sequence[tuple[str, int]], words: int) -> Iterator[list[str]]:
    """Files in order, as many at once as the bits of one broadcast allow (always at least one)."""
    taken, held = [], 0
    for file, size in sizes:
        if taken and held + size > words:
            yield taken
            taken, held = [], 0
        taken.append(file)
        held += size
    if taken:
        yield taken


def _read_flagged(written: DataFrame, flagged: DataFrame, columns: Sequence[str], words: int) -> DataFrame:
    """Rows of ``written`` whose flag is set; ``flagged(_file, _row, _hit)`` has every row of it."""
    spark = written.sparkSession
    bit = F.when(F.col("_hit"), F.expr(f"shiftleft(1L, cast(_row % {_WORD} as int))")).otherwise(F.lit(0).cast("long"))
    word = F.floor(F.col("_row") / _WORD).cast("int")
    # One row per word first, so that a file with many rows is gathered as a short list of words.
    by_word = flagged.groupBy("_file", word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    in_order = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    by_file = by_word.groupBy("_file").agg(F.transform(in_order, lambda w: w["_bits"]).alias("_bits"))
    by_file = materialize(by_file.where(F.exists("_bits", lambda w: w != 0)), "wanted-rows")
    # The list of files is what a scan of them keeps on the driver anyway.
    sizes = sorted((r["_file"], r["n"]) for r in by_file.select("_file", F.size("_bits").alias("n")).collect())
    if not sizes:
        return written.select(*columns).limit(0)
    parts = []
    for files in _turns(sizes, words):
        bits = by_file.where(F.col("_file").between(files[0], files[-1])).withColumnRenamed("_file", "_of")
        rows = spark.read.schema(written.schema).parquet(*files).select(*columns, *_place())
        row = F.col("_row")
        wanted = F.bit_get(F.get("_bits", F.floor(row / _WORD).cast("int")), (row % _WORD).cast("int")) == 1
        parts.append(rows.join(F.broadcast(bits), F.col("_file") == F.col("_of")).where(wanted).select(*columns))
    return reduce(DataFrame.unionByName, parts)


def read_wanted(
    written: DataFrame, key: str, wanted: DataFrame, columns: Sequence[str], words: int = WORDS
) -> DataFrame:
    """The ``columns`` of the rows whose key is in ``wanted(key)``; nulls are no key.

    ``written`` is a plain read of Parquet files. Only keys are joined.
    """
    keys = wanted.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    rows = written.select(F.col(key).alias("_own"), *_place())
    flagged = rows.join(keys, F.col("_own") == F.col("_key"), "left").select("_file", "_row", "_hit")
    return _read_flagged(written, flagged, columns, words)


def read_first_of(written: DataFrame, key: str, columns: Sequence[str], words: int = WORDS) -> DataFrame:
    """The ``columns`` of one row for each value of a key: the first by place; a null key has none."""
    rows = written.select(F.col(key).alias("_key"), *_place()).where(F.col("_key").isNotNull())
    first = rows.groupBy("_key").agg(F.min(F.struct("_file", "_row")).alias("_first")).select("_first.*", F.lit(True).alias("_hit"))
    flagged = written.select(*_place()).join(first, ["_file", "_row"], "left")
    return _read_flagged(written, flagged, columns, words)


class Payloads:
    """Files by content: ``refs(url, digest, n_bytes, is_cut)`` for all, and each content once."""

    def __init__(self, staged: DataFrame) -> None:
        self._staged = staged

    @property
    def refs(self) -> DataFrame:
        return self._staged.select("url", "digest", "n_bytes", "is_cut")

    def contents(self, known: DataFrame | None = None) -> DataFrame:
        """``digest, data``: every content once, without those whose digest is known."""
        if known is None:
            return read_first_of(self._staged, "digest", ["digest", "data"])
        digests = self._staged.select("digest").distinct().join(known.select("digest"), "digest", "left_anti")
        fresh = materialize(read_wanted(self._staged, "digest", digests, ["digest", "data"]), "fresh-payloads")
        return read_first_of(fresh, "digest", ["digest", "data"])


def stage_files(files: DataFrame, cap: int | None = None) -> Payloads:
    """Write ``files(url, content)`` once, in the layout in which they come, with the SHA-256 of each.

    ``cap`` is the most bytes a file may have; ``is_cut`` tells whether something was taken off. A null
    content counts as empty.
    """
    content = F.coalesce("content", F.lit(b""))
    data, is_cut = (content, F.lit(False)) if cap is None else (F.substring(content, 1, cap), F.octet_length(content) > cap)
    rows = files.select("url", data.alias("data"), is_cut.alias("is_cut"))
    return Payloads(materialize(
        rows.select("url", F.sha2("data", 256).alias("digest"), F.octet_length("data").cast("long").alias("n_bytes"), "is_cut", "data"),
        "payloads",
    ))
