"""Near-duplicates by SimHash fingerprints and pivot distance tables.

Fingerprints within a few bits of each other are linked, and documents get the component of their
fingerprint. Copies meet only as one distinct fingerprint.

Candidates: a fingerprint is cut into ``2 * max_bits`` blocks. Two that differ in at most
``max_bits`` bits agree in at least ``max_bits`` whole blocks, so every link shares one of the keys
made of that many blocks. Within a key the pivot table decides: by the triangle inequality two
fingerprints whose distances to any pivot differ by more than ``max_bits`` cannot be linked. What
survives is verified bit by bit.

A key emits a spanning forest of its links, never all pairs. Keys with more fingerprints than
``UNIT`` are cut into parts, and each pair of parts is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.llm.common import runs_of, text_or_empty
from crawlmill.llm.components import connected_components
from crawlmill.session import materialize

SEED = 42
PIVOTS = 16
UNIT = 4096
STEP = 1 << 16  # hashes whose bits are counted at once


def fingerprint(text: bytes, words: int) -> int:
    """Signed 64-bit SimHash of UTF-8 text; 0 without words."""
    found = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(found) - words + 1)
    pairs = zip(starts[:count].tolist(), ends[min(words, len(found)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in pairs], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, STEP):
        bits = hashes[at : at + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, fp) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            values = pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), values], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def block_masks(max_bits: int) -> list[int]:
    """Masks of all choices of ``max_bits`` blocks out of twice as many (for 0 bits: everything)."""
    count = 2 * max_bits
    if not count:
        return [_signed((1 << 64) - 1)]
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(blocks, max_bits)]


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints, the same everywhere."""
    return [_signed(xxhash.xxh64_intdigest(bytes([i]), SEED)) for i in range(count)]


def _pivot_distances(fp: Column) -> Column:
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots()])


def link_forest(fps: np.ndarray, distances: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the given distinct fingerprints."""
    order = np.argsort(distances[:, 0], kind="stable")
    fps, distances = fps[order], distances[order]
    bits = fps.view(np.uint64)  # bitwise_count looks at absolute values
    reach = np.searchsorted(distances[:, 0], distances[:, 0] + max_bits, side="right")
    parent = list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    for i in range(len(fps) - 1):
        others = np.arange(i + 1, reach[i])
        near = others[(np.abs(distances[others] - distances[i]) <= max_bits).all(axis=1)]
        for j in near[np.bitwise_count(bits[near] ^ bits[i]) <= max_bits].tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                forest.append((int(fps[i]), int(fps[j])))
    return forest


def fingerprint_links(fps: DataFrame, max_bits: int, unit: int = UNIT) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints ``fp`` within ``max_bits`` bits."""
    masks = F.array(*[F.lit(m) for m in block_masks(max_bits)])
    keyed = fps.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        "fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("part")
    )
    sizes = keyed.groupBy("choice", "part").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keyed.join(sizes, ["choice", "part"]).withColumn("parts", F.ceil(F.col("n") / unit))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    tasks = shared.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    # Two tasks with the same hash are worked on as one, which changes nothing.
    tasks = tasks.select(
        F.xxhash64("choice", "part", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"),
        "fp",
        _pivot_distances(F.col("fp")).alias("distances"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "task"):
            rows = rows.combine_chunks()
            found, first = np.unique(rows.column("fp").to_numpy(), return_index=True)
            if len(found) < 2:
                continue
            table = rows.column("distances").combine_chunks().flatten().to_numpy()
            table = table.reshape(-1, PIVOTS)[first].astype(np.int16)
            if forest := link_forest(found, table, max_bits):
                u, v = zip(*forest)
                yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, "u long, v long")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased (A-Z), split at ASCII blanks and hashed as shingles of ``words`` words with
    repeats; a text with fewer words is one shingle, one without words (empty, blank or null) has
    fingerprint zero and is linked like any other. component_id is the smallest id that can be
    reached over links of at most ``max_bits`` differing bits. Null ids are never the smallest,
    unless a component has no other. Repeated rows come out as often as they come in; other columns
    are not read; an empty table gives an empty result. Fingerprints, links and components are
    written to the shared folder.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct_fingerprints")
    reached = connected_components(fingerprint_links(distinct.select("fp"), max_bits))
    members = distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    members = materialize(members, "members")
    least = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = materialize(members.join(least, "component").select("fp", "component_id"), "components")
    return marked.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
