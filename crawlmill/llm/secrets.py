"""Secret scans: fixed patterns, and values in credential contexts that are hard to guess."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.llm.common import text_or_empty
from crawlmill.llm.guess_cost import Words, guess_cost, public_words

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so short runs need no match
CONTEXT = re.compile(
    r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|credentials?|token|login|(?:api|access|private|auth)[_-]?(?:key|token))"""
    r"""["']?[\x20\t]*(?::|=>?|[\x20\t]is[\x20\t])[\x20\t]*["']?([^\s"']+)""",
    re.I | re.A,
)
CONTEXT_WORDS = ("pass", "pwd", "pin", "secret", "credential", "token", "login", "key")
LEAST_COST = 10.0
MARK = "[SECRET]"

Span = tuple[int, int, str, float | None]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: (start, end, kind, None), by start, then kind as listed."""
    lowered = text.lower()
    found: list[Span] = []
    if any(w in lowered for w in ASSIGN_WORDS):
        # Short values count as read: what follows them is searched from their end.
        found += [(*m.span(), "assign", None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access", None) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(*m.span(), "hex", None) for m in HEX.finditer(text)]
    return _ordered(found)


def _ordered(found: list[Span]) -> list[Span]:
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _stretches(found: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what ordered spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, *_ in found:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _covered(start: int, end: int, starts: list[int], ends: list[int]) -> bool:
    """Whether stretches, also several that touch, cover all from ``start`` to ``end``."""
    while start < end:
        before = bisect_right(starts, start)
        if not before or ends[before - 1] <= start:
            return False
        start = ends[before - 1]
    return True


def all_spans(text: str, words: Words, least_cost: float = LEAST_COST) -> list[Span]:
    """The base spans, and of credential-context values they do not cover wholly those that cost enough."""
    base = base_spans(text)
    lowered = text.lower()
    added: list[Span] = []
    if any(w in lowered for w in CONTEXT_WORDS):
        starts, ends = _stretches(base)
        for match in CONTEXT.finditer(text):
            value = match[1].rstrip(".,;:!?)]}")
            start, end = match.start(1), match.start(1) + len(value)
            if _covered(start, end, starts, ends):
                continue
            cost = guess_cost(value, words)
            if cost >= least_cost:
                added.append((start, end, "guess", cost))
    return _ordered(base + added)


def secret_spans(
    docs: DataFrame,
    words_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_cost: float = LEAST_COST,
) -> DataFrame:
    """One row per row of ``docs``: id, spans (start, end, kind, cost), in code points, end exclusive.

    ``words_path`` is a public vocabulary file whose order ranks the words; workers read it from
    there. Spans are ordered by start, then kind. Null and empty texts have none. Other columns are
    not read; repeated rows come out as they come in; an empty table gives an empty result. A row is
    worked on alone, in time linear in its text.
    """
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("spans", T.ArrayType(T.StructType([
                T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                T.StructField("kind", T.StringType()), T.StructField("cost", T.DoubleType()),
            ]))),
        ]
    )
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("cost", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = public_words(words_path)
        for batch in batches:
            found = [
                [dict(zip(("start", "end", "kind", "cost"), s)) for s in all_spans(t.as_py(), words, least_cost)]
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, arrow)], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redacted(text: str, found: list[Span], mark: str = MARK) -> str:
    """``text`` with each stretch of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for start, end in zip(*_stretches(found)):
        parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, words_path: str, text_col: str = "text", least_cost: float = LEAST_COST) -> DataFrame:
    """``docs`` with secrets replaced in the text; all rows and columns stay, null texts too."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = public_words(words_path)
        for batch in batches:
            texts = [
                t.as_py() and redacted(t.as_py(), all_spans(t.as_py(), words, least_cost))
                for t in batch.column(place)
            ]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
