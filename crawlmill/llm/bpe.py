"""Byte-level BPE encoding over a table of distinct words, and decoding through a join.

Splitting a text into words is a column expression, and a word's ids depend on nothing but the word.
So texts are gathered into chunks of words; a chunk is one row that holds its distinct words once and
its texts as compressed numbers of these words. The words of all chunks make the distinct-word
table: each distinct word is encoded once, and its ids go back to the chunks that have it. There they
are put in the places of the word. Chunks bound the memory of a task, a word comes once per chunk to
the join, and texts travel once, compressed.

Decoding joins every id with its piece of the vocabulary, whose size is fixed; the pieces of a text
stay in the order of their positions.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.llm.common import list_offsets, small_batches, text_or_empty

CHUNK_WORDS = 1_500_000  # some 8 MB of text
HELD_WORDS = 200_000  # words of chunks that are encoded at once, and more only by a bucket
BUCKET_LETTERS = 2_000_000  # of text for each bucket of words
STEP_TEXTS = 256  # decoded at once
STEP_WORDS = 500_000  # put back at once
BLANK = r"\p{IsWhite_Space}"
#: How byte-level BPE splits a text: contractions, letters, digits and signs with a blank before, blanks.
WORD = (
    rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+|{BLANK}+(?![^{BLANK}])|{BLANK}+"
)


class Vocabulary:
    """What a tokenizers file says about ids, pieces and added tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.path = path
        self.added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        letters = _byte_letters()
        self.pieces = {i: _piece(piece, letters) for piece, i in parts["model"]["vocab"].items()}
        self.pieces |= {i: _piece(piece, letters) for piece, i in self.added.items()}


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself, or the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _piece(piece: str, letters: dict[str, int]) -> bytes:
    if all(c in letters for c in piece):
        return bytes(letters[c] for c in piece)
    return piece.encode()


def words_of(text: Column, added: Sequence[str] = ()) -> Column:
    """The words of a text in order; strung together they are the text. Added tokens are words."""
    plain = lambda part: F.regexp_extract_all(part, F.lit(WORD), F.lit(0))
    if not added:
        return plain(text)
    if len(added) > 1:
        raise ValueError("one added token at most")
    token = F.lit(added[0])
    parts = F.split(text, "\\Q" + added[0] + "\\E", -1)
    pieces = F.transform(parts, lambda part, i: F.when(i > 0, F.concat(F.array(token), plain(part))).otherwise(plain(part)))
    return F.when(F.contains(text, token), F.flatten(pieces)).otherwise(plain(text))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte of their places."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().view(np.int32)


def _chunk(chunk: int, ids: list[pa.Array], counts: list[np.ndarray], words: list[pa.DictionaryArray]) -> pa.RecordBatch:
    """One row for the texts; the most frequent words have the smallest numbers."""
    parts = pa.chunked_array(words).unify_dictionaries()
    number = np.concatenate([p.indices.to_numpy() for p in parts.chunks])
    distinct = parts.chunk(parts.num_chunks - 1).dictionary
    order = np.argsort(-np.bincount(number, minlength=len(distinct)), kind="stable")
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order))
    distinct = distinct.take(pa.array(order))
    sizes = np.diff(np.frombuffer(distinct.buffers()[1], "<i4")[: len(distinct) + 1]) if len(distinct) else np.zeros(0, int)
    spelled = b"".join(distinct.to_pylist())
    texts, codes = pa.concat_arrays(ids).to_pylist(), _packed(rank[number])
    row = {
        "chunk": pa.array([chunk], pa.int64()),
        "ids": pa.array([texts], pa.list_(pa.int64())),
        "counts": pa.array([np.concatenate(counts)], pa.list_(pa.int32())),
        "codes": pa.array([codes], pa.binary()),
        "sizes": pa.array([_packed(sizes)], pa.binary()),
        "spelled": pa.array([zstandard.ZstdCompressor(level=3).compress(spelled)], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(row)


CHUNK_SCHEMA = "chunk long, ids array<long>, counts array<int>, codes binary, sizes binary, spelled binary"


def _chunks(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Chunks of the texts of docs (id, words); a text is never split."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        counts: list[np.ndarray] = []
        words: list[pa.DictionaryArray] = []
        held = 0
        # A task's chunks are numbered in its part of the numbers.
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = batch.column("words").offsets.to_numpy()
            at = 0
            while at < batch.num_rows:
                # Up to the text that fills the chunk; only its words' numbers are held.
                end = min(int(np.searchsorted(ends, ends[at] + chunk_words - held)), batch.num_rows)
                end = max(end, at + 1)
                ids.append(batch.column("id").slice(at, end - at))
                counts.append(np.diff(ends[at : end + 1]))
                flat = batch.column("words").values.slice(ends[at], ends[end] - ends[at])
                words.append(flat.cast(pa.binary()).dictionary_encode())
                held += len(flat)
                at = end
                if held >= chunk_words:
                    yield _chunk(chunk, ids, counts, words)
                    ids, counts, words, held = [], [], [], 0
                    chunk += 1
        if ids:
            yield _chunk(chunk, ids, counts, words)

    return docs.mapInArrow(run, CHUNK_SCHEMA)


SPELLED_SCHEMA = "bucket long, chunk long, codes binary, sizes binary, spelled binary"


def _spell(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of chunks, one row for each bucket of words."""
    pack, unpack = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in batch.to_pylist():
            sizes = _unpacked(row["sizes"])
            ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            words = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(unpack(row["spelled"]))]
            ).to_pylist()
            bucket = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64) % np.uint64(buckets)
            code = np.argsort(bucket, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[code])) + 1, [len(code)])) if len(code) else [0]
            rows = [
                (int(bucket[part[0]]), row["chunk"], _packed(np.diff(part, prepend=0)), _packed(sizes[part]), pack(b"".join([words[i] for i in part])))
                for part in (code[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
            ]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            for at in range(0, len(rows), 1000):
                columns = [pa.array(c, k) for c, k in zip(zip(*rows[at : at + 1000]), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "codes", "sizes", "spelled"])


FOUND_SCHEMA = "of long, numbers binary, sizes binary, flat binary"


def _by_chunk(chunks: np.ndarray, codes: np.ndarray, ids: pa.ListArray) -> pa.RecordBatch:
    """One row for each chunk: the numbers of its words here, and their ids."""
    order = np.lexsort((codes, chunks))
    chunks, codes, ids = chunks[order], codes[order], ids.take(pa.array(order))
    flat, ends = list_offsets(ids)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(chunks)) + 1, [len(chunks)]))
    rows = [
        (int(chunks[a]), _packed(np.diff(codes[a:b], prepend=0)), _packed(np.diff(ends[a : b + 1])), _packed(flat[ends[a] : ends[b]]))
        for a, b in zip(cuts[:-1], cuts[1:])
    ]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["of", "numbers", "sizes", "flat"])


def word_table(spelled: DataFrame, path: str) -> DataFrame:
    """(of, numbers, sizes, flat): the words of all chunks with their ids, packed by chunk.

    ``spelled`` is dealt by bucket, which brings the places of each distinct word together; the
    tokenizer itself encodes the word once and its ids go to all its places. There are as many buckets
    as keep one small.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        unpack = zstandard.ZstdDecompressor().decompress
        chunks: list[np.ndarray] = []
        codes: list[np.ndarray] = []
        words: list[pa.Array] = []
        last, held = None, 0

        def encoded() -> pa.RecordBatch:
            parts = pa.chunked_array(words).dictionary_encode().unify_dictionaries()
            distinct = parts.chunk(0).dictionary.cast(pa.string()).to_pylist()
            found = tokenizer.encode_batch_fast(distinct, add_special_tokens=False)
            ids = pa.array([e.ids for e in found], pa.list_(pa.int32()))
            number = np.concatenate([p.indices.to_numpy() for p in parts.chunks])
            return _by_chunk(np.concatenate(chunks), np.concatenate(codes), ids.take(pa.array(number)))

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != last and held >= HELD_WORDS:
                    yield encoded()
                    chunks, codes, words, held = [], [], [], 0
                last = row["bucket"]
                code, sizes = np.cumsum(_unpacked(row["codes"])), _unpacked(row["sizes"])
                ends = np.concatenate(([0], np.cumsum(sizes))).astype("<i4")
                words.append(pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(unpack(row["spelled"]))]))
                chunks.append(np.full(len(code), row["chunk"]))
                codes.append(code)
                held += len(code)
        if words:
            yield encoded()

    return spelled.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FOUND_SCHEMA)


def _put_back(chunks: pa.Table, words: pa.Table) -> pa.Table:
    """Texts as ids, from the chunk and the ids of its words."""
    packs, none = words.to_pylist(), np.empty(0, dtype=np.int32)
    code = np.concatenate([none, *[np.cumsum(_unpacked(r["numbers"])) for r in packs]]).astype(np.int64)
    size = np.concatenate([none, *[_unpacked(r["sizes"]) for r in packs]]).astype(np.int64)
    flat = np.concatenate([none, *[_unpacked(r["flat"]) for r in packs]])
    starts = np.zeros(code.max(initial=-1) + 1, dtype=np.int64)
    sizes = np.full(len(starts), -1, dtype=np.int64)
    starts[code], sizes[code] = np.cumsum(size) - size, size
    texts, lists = [], []
    for row in chunks.to_pylist():
        numbers = _unpacked(row["codes"])
        if len(numbers) and (numbers.max() >= len(sizes) or sizes[numbers].min() < 0):
            raise ValueError("a chunk lacks some of its words")
        borders = np.concatenate(([0], np.cumsum(row["counts"]))).astype(np.int64)
        at = 0
        while at < len(borders) - 1:  # some texts at a time
            end = max(at + 1, int(np.searchsorted(borders, borders[at] + STEP_WORDS, side="right")) - 1)
            part = numbers[borders[at] : borders[end]]
            length = sizes[part]
            ends = np.concatenate(([0], np.cumsum(length)))
            place = np.repeat(starts[part] - ends[:-1], length) + np.arange(ends[-1])
            cuts = ends[borders[at : end + 1] - borders[at]]
            lists.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat[place], pa.int32())))
            texts.append(pa.array(row["ids"][at:end], pa.int64()))
            at = end
    return pa.table({"id": pa.chunked_array(texts, pa.int64()), "ids": pa.chunked_array(lists, pa.list_(pa.int32()))})


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), as the tokenizer at ``path`` encodes the text.

    ``path`` is a byte-level BPE file of the tokenizers library, read by driver and workers. Null and
    empty texts have no ids. Texts may hold the added token. Repeated rows come out as they come in;
    other columns are not read; an empty table gives an empty result. A text longer than a chunk is a
    chunk of its own.
    """
    small_batches(docs.sparkSession)
    added = list(Vocabulary(path).added)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    letters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + letters // BUCKET_LETTERS
    rows = texts.select("id", words_of(F.col("text"), added).alias("words"))
    chunks = _chunks(rows, chunk_words).repartition("chunk")
    # Both uses read all columns, so that the one shuffle of the chunks serves both.
    spelled = chunks.mapInArrow(lambda batches: _spell(batches, buckets), SPELLED_SCHEMA)
    found = word_table(spelled, path)
    put = chunks.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(_put_back, "id long, ids array<int>")
    return put.withColumnRenamed("id", id_col)


def ids_digests(ids: pa.ListArray) -> list[str]:
    """SHA-256 of the ids as decimal numbers, joined by commas."""
    flat, ends = list_offsets(ids)
    numbers = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(pa.string()))
    return [hashlib.sha256(line.as_buffer()).hexdigest() for line in pc.binary_join(numbers, ",")]


def decode(
    encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", carry: Sequence[str] = (),
    digests: bool = False,
) -> DataFrame:
    """One row per row of ``encoded``: id, the columns ``carry``, text, and with ``digests`` ids_sha256.

    Every id is joined with its piece of the vocabulary at ``path``. The piece table goes to all
    workers; its size is that of the vocabulary and does not grow with the data. It is laid out by
    id, so the join is a lookup by place, keeps the order of the ids and needs no shuffle. Ids
    outside the vocabulary give nothing, bytes that are no UTF-8 the replacement character, null or
    empty arrays the empty text.
    """
    spelled = Vocabulary(path).pieces
    most = max(spelled, default=-1) + 1
    pieces = [spelled.get(i, b"") for i in range(most)] + [b""]
    kinds = {f.name: f.dataType.simpleString() for f in encoded.schema}
    columns = [id_col, *carry]

    def texts(table: pa.Array, ids: pa.ListArray) -> list[str]:
        numbers, borders = list_offsets(ids)
        numbers = np.where((numbers >= 0) & (numbers < most), numbers, most)
        joined = table.take(pa.array(numbers))
        ends = np.frombuffer(joined.buffers()[1], "<i4")[: len(joined) + 1] if len(joined) else np.zeros(1, int)
        data = memoryview(joined.buffers()[2]) if len(joined) else memoryview(b"")
        cuts = ends[borders].tolist()
        return [str(data[a:b], "utf-8", "replace") for a, b in zip(cuts, cuts[1:])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(pieces, pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_TEXTS):
                part = batch.slice(at, STEP_TEXTS)
                ids = part.column("_ids")
                made = [pa.array(texts(table, ids), pa.string())]
                made += [pa.array(ids_digests(ids), pa.string())] if digests else []
                names = [*columns, "text", "ids_sha256"][: len(columns) + len(made)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *made], names)

    named = encoded.withColumn("_ids", F.coalesce(F.col(ids_col), F.array().cast("array<int>"))).select(*columns, "_ids")
    schema = [f"`{c}` {kinds[c]}" for c in columns] + ["text string"] + ["ids_sha256 string"] * digests
    return named.mapInArrow(run, ", ".join(schema))
