"""Document fingerprints by Order MinHash.

A text is the set of its k-mers of code points, each numbered by its occurrence. Every one of ``SKETCHES``
hash functions picks the ``LENGTH`` least of them; the k-mers picked are put back into the order of the
text, and the tuple is hashed to one entry. Two texts agree in an entry if the same k-mers are least in
both and stand in the same order, so the share of equal entries falls with the edit distance, and
rearranged texts differ although their k-mers are the same.

``compare_with_next`` holds each text against an edited one and against its successor. Texts are shuffled
once, by ranges of their id; a task reads its range in order and holds two texts and one batch. Only the last
text of a range has its successor in another range: the ends of all ranges are two rows a task, which a
second, small job joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.llm.common import small_batches, text_or_empty
from crawlmill.session import materialize

KMER = 8
LENGTH = 2
SKETCHES = 64
STEP = 4096  # k-mers that all functions look at together

_BASE, _MIX, _MORE = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MORE
    return x ^ (x >> np.uint64(31))


def _windows(codes: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of each run of ``size`` code points, from the hashes of its halves."""
    if size == 1:
        return codes + np.uint64(1)
    left, right = size // 2, size - size // 2
    power = np.uint64(pow(int(_BASE), right, 1 << 64))
    heads = _windows(codes, left)
    tails = heads if left == right else _windows(codes, right)
    return heads[: len(codes) - size + 1] * power + tails[left:]


PLACE_BITS = 24  # of a place; longer texts need more


def numbered_kmers(text: str, size: int = KMER) -> tuple[np.ndarray, np.ndarray]:
    """All k-mers in the order of their hashes: (hash and place in one number, 32-bit hash with occurrence number).

    The place is in the low ``PLACE_BITS`` (more in texts that need them); k-mers count as equal if their
    hashes agree in the other bits. A text shorter than ``size`` is one k-mer.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    hashes = _mixed(_windows(codes, min(size, len(codes))))
    bits = np.uint64(max(PLACE_BITS, len(codes).bit_length()))
    keys = np.sort((hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64))
    kmers = keys >> bits
    number = np.ones(len(keys), dtype=np.uint64)
    repeats = np.flatnonzero(kmers[1:] == kmers[:-1]) + 1
    if len(repeats):
        place = np.arange(len(repeats))
        opens = np.concatenate(([True], repeats[1:] != repeats[:-1] + 1))
        number[repeats] = place - np.maximum.accumulate(np.where(opens, place, 0)) + 2
    number *= _BASE
    number += kmers
    number *= _MIX
    return keys, (number >> np.uint64(32)).astype(np.uint32)


class OrderMinHash:
    """Fingerprints of texts: ``sketches`` entries of four bytes."""

    def __init__(self, sketches: int = SKETCHES, length: int = LENGTH, size: int = KMER, seed: int = 1) -> None:
        self.size, self.length, self.sketches = size, length, sketches
        draw = np.random.default_rng(seed)
        self._factors = draw.integers(0, 1 << 31, (sketches, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self._ranks: np.ndarray | None = None  # made by each worker

    def _least(self, keys: np.ndarray, numbered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and keys of k-mers among which are the least of each function."""
        if self._ranks is None:
            self._ranks = np.empty((self.sketches, STEP), dtype=np.uint32)
        rows = np.arange(self.sketches)
        values, picks = [np.empty((0, self.sketches), np.uint32)], [np.empty((0, self.sketches), np.int64)]
        for at in range(0, len(numbered), STEP):
            some = numbered[None, at : at + STEP]
            ranks = np.multiply(some, self._factors, out=self._ranks[:, : some.shape[1]])
            for _ in range(min(self.length, some.shape[1])):
                least = ranks.argmin(axis=1)
                values.append(ranks[None, rows, least])
                picks.append(least[None] + at)
                ranks[rows, least] = np.uint32(0xFFFFFFFF)
        return np.concatenate(values).T, keys[np.concatenate(picks).T]

    def fingerprint(self, text: str) -> bytes:
        values, keys = self._least(*numbered_kmers(text, self.size))
        rows = np.arange(self.sketches)[:, None]
        # Equal ranks go by key, in whose order the k-mers come.
        keys = keys[rows, values.argsort(axis=1, kind="stable")[:, : self.length]]
        bits = np.uint64(max(PLACE_BITS, len(text).bit_length()))
        places = keys & np.uint64((1 << int(bits)) - 1)
        entry = np.zeros(self.sketches, dtype=np.uint64)
        for column in (keys >> bits)[rows, places.argsort(axis=1)].T:
            entry = _mixed(entry * _BASE + column + np.uint64(1))
        return (entry >> np.uint64(32)).astype(">u4").tobytes()


def likeness(one: bytes, other: bytes) -> float:
    """Share of equal entries."""
    return float(np.mean(np.frombuffer(one, ">u4") == np.frombuffer(other, ">u4")))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


#: What is known of a text: all but ``id``, ``part`` and ``text`` are null at the ends of a range.
_FOUND = [
    ("n_chars", T.LongType(), pa.int64()),
    ("edited_sha256", T.StringType(), pa.string()),
    ("edited_fingerprint", T.BinaryType(), pa.binary()),
    ("near_edited", T.DoubleType(), pa.float64()),
    ("near_next", T.DoubleType(), pa.float64()),
]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _ranges(docs: DataFrame, scheme: OrderMinHash) -> DataFrame:
    """Every text compared with the next of its range, and the first and the last text of each range.

    Columns: id, fingerprint, part and text (at the ends), is_first, and those of ``_FOUND``.
    """
    digest, origin = F.xxhash64("text"), F.spark_partition_id()
    keyed = docs.select("id", "text", digest.alias("digest"), origin.alias("origin"))
    order = [F.col("id").asc_nulls_first(), F.col("digest"), F.col("origin")]
    spread = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    schema = T.StructType(
        [docs.schema["id"], T.StructField("fingerprint", T.BinaryType()), T.StructField("part", T.IntegerType()), T.StructField("is_first", T.BooleanType()), T.StructField("text", T.StringType())]
        + [T.StructField(name, kind) for name, kind, _ in _FOUND]
    )
    kinds = [pa.binary(), pa.int32(), pa.bool_(), pa.string(), *[kind for *_, kind in _FOUND]]
    nothing = (None,) * len(_FOUND)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = waiting = kind = None  # the row before: (id, text); the one before that: all but near_next
        ids, rows = [], []

        def settle(own: bytes) -> None:
            """The fingerprint of the last row is known, so the one before it is complete."""
            if waiting:
                name, before, *found = waiting
                ids.append(name)
                rows.append((before, None, None, None, *found, likeness(before, own)))
            else:
                ids.append(last[0])
                rows.append((own, part, True, last[1], *nothing))

        def filled() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(kinds)
            batch = pa.RecordBatch.from_arrays([pa.array(ids, kind), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=schema.names)
            ids.clear()
            rows.clear()
            return batch

        for batch in batches:
            kind = batch.column("id").type
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if last:
                    changed = edited(last[1], text)
                    own = scheme.fingerprint(last[1])
                    other = own if changed == last[1] else scheme.fingerprint(changed)
                    settle(own)
                    waiting = (last[0], own, len(last[1]), _sha256(changed), other, likeness(own, other))
                last = (name, text)
            yield filled()
        if last:
            own = scheme.fingerprint(last[1])
            settle(own)
            ids.append(last[0])
            rows.append((own, part, False, last[1], *nothing))
            yield filled()

    return spread.mapInArrow(run, schema)


def _joined_ends(ends: DataFrame, scheme: OrderMinHash) -> DataFrame:
    """The last text of each range compared with the first of the next; behind the last range comes the first."""
    spark = ends.sparkSession
    parts = sorted(r["part"] for r in ends.where("is_first").select("part").collect())  # one for each task at most
    pairs = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, following int")
    firsts = ends.where("is_first").select(F.col("part").alias("following"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    rows = ends.where("not is_first").select("id", "fingerprint", "part", "text").join(pairs, "part").join(firsts, "following")
    schema = T.StructType([ends.schema["id"], T.StructField("fingerprint", T.BinaryType()), *[T.StructField(name, kind) for name, kind, _ in _FOUND]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, own, following, theirs in zip(*[batch.column(c).to_pylist() for c in ("text", "fingerprint", "next_text", "next_print")]):
                changed = edited(text, following)
                other = scheme.fingerprint(changed)
                found.append((len(text), _sha256(changed), other, likeness(own, other), likeness(own, theirs)))
            columns = list(zip(*found)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("fingerprint"), *[pa.array(c, k) for c, (_, _, k) in zip(columns, _FOUND)]], names=schema.names
            )

    return rows.select("id", "text", "fingerprint", "next_text", "next_print").mapInArrow(run, schema)


def fingerprints(docs: DataFrame, scheme: OrderMinHash | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, without a shuffle; a null text counts as empty."""
    scheme = scheme or OrderMinHash()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("fingerprint", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scheme.fingerprint(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=schema.names)

    small_batches(docs.sparkSession)
    return rows.mapInArrow(run, schema).select(F.col("id").alias(id_col), _hex("fingerprint"))


def _hex(column: str) -> Column:
    return F.lower(F.hex(column)).alias(column)


def compare_with_next(docs: DataFrame, scheme: OrderMinHash | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next text is that of the next id, nulls first; behind the last comes the first, and a single row
    follows itself. Rows of one id follow each other in a fixed order of their texts. A null text counts as
    empty; empty texts have equal fingerprints of their own. A text shorter than a k-mer is one k-mer. Other
    columns, whatever their names, are not read. An empty table gives an empty result.
    """
    scheme = scheme or OrderMinHash()
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    found = materialize(_ranges(rows, scheme), "ranges")
    columns = ["id", "fingerprint", *[name for name, *_ in _FOUND]]
    whole = found.where("part is null").select(*columns).unionByName(_joined_ends(found.where("part is not null"), scheme))
    return whole.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", _hex("fingerprint"), _hex("edited_fingerprint"), "near_edited", "near_next"
    )
