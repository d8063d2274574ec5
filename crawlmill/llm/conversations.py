"""Repair of conversation structure by a shortest path over scalar big-integer weights.

A repaired conversation has the roles ``(system? (user assistant)+)?``. The edits of a row, from the
first to the last, are the edges of a directed acyclic graph whose nodes are (rows so far, role seen
last, inserts left here). An edge weighs one integer: its high digits carry the cost, and below them stand
positional digits of fixed width, one for each letter of the audit, with zeros behind the last letter. The
least integer is then the cheapest audit, of equally cheap ones the first by ASCII; nothing else decides.

The path is found from the end: an edge puts its letter in front and moves the letters behind it by one
digit. Edges that leave a node bear different letters, so audits from one node differ where they first
part; letters beyond the rows of a block never decide, and a block of rows passes only costs on to the
block before it. A conversation of any length thus needs integers of one block's width, four costs for each
block, and two characters for each row.

The rows of all conversations are sorted and written once. Repeats are found by joins over digests, a
conversation meets as a string of two characters a row, and texts are only streamed: a conversation that
holds a third of all rows is sorted and marked by many tasks. Its audit and its digest are single values,
so one task makes these, holding two characters a row and one batch of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.llm.common import small_batches
from crawlmill.operators.ranking import numbered
from crawlmill.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# Cost of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

LETTERS = "DIKR"  # in ASCII order; the digit of a letter is its place, from 1
BITS = 3
ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
DONE = (START, ASSISTANT)
DEAD = 1 << 48  # cost of what is not allowed
INSERTS = 2  # three in a row come back to a role that stood before
BLOCK = 64


def _inserted(state: int) -> str:
    return "a" if state == USER else "u"


def _row_edges(mark: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row: its initial and its fault."""
    edges = [("D", DELETE, state)]
    if mark[1] not in "bd":
        more = TRUNCATED if mark[1] == "t" else 0
        if mark[0] in NEXT[state]:
            edges.append(("K", KEEP + more, NEXT[state][mark[0]]))
        edges.append(("R", REROLE + more, NEXT[state][_inserted(state)]))
    return edges


_EDGES = {(initial + fault, state): _row_edges(initial + fault, state) for initial in "suao" for fault in "-tbd" for state in range(4)}


class _Block:
    """The weights of the nodes of some rows, given the costs behind them."""

    def __init__(self, marks: list[str], behind: list[int], last: bool) -> None:
        self.marks = marks
        self.width = BITS * (INSERTS + 1) * (len(marks) + 1)
        self.low = (1 << self.width) - 1
        ends = [cost << self.width for cost in behind]
        self.nodes = [self._with_inserts(ends) if last else [ends] * (INSERTS + 1)]
        for mark in reversed(marks):
            ahead = self.nodes[-1][INSERTS]
            self.nodes.append(
                self._with_inserts([min(self._edge(c, cost, ahead[to]) for c, cost, to in _EDGES[mark, state]) for state in range(4)])
            )
        self.nodes.reverse()

    def _edge(self, letter: str, cost: int, weight: int) -> int:
        digits = (LETTERS.index(letter) + 1 << self.width - BITS) | (weight & self.low) >> BITS
        return (weight >> self.width) + cost << self.width | digits

    def _with_inserts(self, weights: list[int]) -> list[list[int]]:
        """By inserts left: the weights of the states."""
        layers = [weights]
        for _ in range(INSERTS):
            layers.append([min(w, self._edge("I", INSERT, layers[-1][NEXT[s][_inserted(s)]])) for s, w in enumerate(weights)])
        return layers

    def costs(self) -> list[int]:
        return [w >> self.width for w in self.nodes[0][INSERTS]]

    def walk(self, state: int) -> tuple[str, int]:
        """The letters of the least path from a state, and the state it leads to."""
        audit, row, left = [], 0, INSERTS
        while digit := (self.nodes[row][left][state] & self.low) >> self.width - BITS:
            letter = LETTERS[digit - 1]
            audit.append(letter)
            if letter == "I":
                state, left = NEXT[state][_inserted(state)], left - 1
            else:
                state = next(to for c, _, to in _EDGES[self.marks[row], state] if c == letter)
                row, left = row + 1, INSERTS
        return "".join(audit), state


@lru_cache(maxsize=4096)
def cheapest_audit(marks: str, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the cheapest repair; ``marks`` has two characters a row.

    The first is the initial of the role: ``s``, ``u``, ``a`` or ``o`` for others. The second is the fault:
    ``-`` none, ``b`` blank, ``d`` duplicate, ``t`` truncated.
    """
    rows = [marks[i : i + 2] for i in range(0, len(marks), 2)]
    cuts = range(0, max(1, len(rows)), block)
    behind = [[0 if state in DONE else DEAD for state in range(4)]]
    for at in reversed(cuts):
        behind.append(_Block(rows[at : at + block], behind[-1], at == cuts[-1]).costs())
    cost = behind.pop()[START]
    audit, state = [], START
    for at in cuts:
        letters, state = _Block(rows[at : at + block], behind.pop(), at == cuts[-1]).walk(state)
        audit.append(letters)
    return cost, "".join(audit)


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32(``conv_id:turn``) mod 20.

    0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes
    its role ``user``. A null counts as one space, in roles, texts and in the number; ``conv_id`` and
    ``turn`` themselves stay null. Other columns, whatever their names, are not read.
    """
    given = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", given("conv_id"), given("turn"))) % 20
    found = rows.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("int")))
    return found.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def place_rows(rows: DataFrame) -> DataFrame:
    """Rows with their order (``seq``), the mark of their role and own faults, and a digest; written once.

    Rows follow each other by turn, nulls first; rows of one turn by role and text.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(F.length(end) == 0, "b").when(F.substring(end, -1, 1).isin(*ENDS), "-").otherwise("t")
    initial = F.substring("role", 1, 1)
    mark = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("o"), fault)
    content = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = numbered(rows.select("conv_id", "turn", "role", "text"), order, "seq")
    return materialize(placed.select("*", mark.alias("mark"), content.alias("content")), "placed_rows")


def _joined(parts: str, order: str) -> Column:
    """The strings of a group, one behind the other."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, parts))), lambda x: x[parts]), "")


def conversation_marks(placed: DataFrame) -> DataFrame:
    """(conv_id, marks, gaps): the marks of all rows of a conversation as one string."""
    narrow = placed.select("conv_id", "seq", "turn", "mark", "content")
    repeats = narrow.groupBy(F.col("conv_id").alias("of"), F.col("content").alias("same")).agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    same = narrow["conv_id"].eqNullSafe(F.col("of")) & (narrow["content"] == F.col("same"))
    found = narrow.join(repeats.filter("n > 1"), same, "left")
    repeated = (F.col("seq") > F.col("first")) & (F.substring("mark", 2, 1) != "b")
    mark = F.when(repeated, F.concat(F.substring("mark", 1, 1), F.lit("d"))).otherwise(F.col("mark"))
    # A slice of the sort first: what one group gathers is never more than a sorted task had.
    slices = found.select("conv_id", F.shiftright("seq", 33).alias("slice"), "seq", mark.alias("mark")).groupBy("conv_id", "slice").agg(_joined("mark", "seq").alias("marks"))
    marks = slices.groupBy("conv_id").agg(_joined("marks", "slice").alias("marks"))
    turns = narrow.groupBy(F.col("conv_id").alias("of")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    return marks.join(turns, marks["conv_id"].eqNullSafe(turns["of"])).drop("of")


def audit_conversations(placed: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit; written once.

    ``conversations`` has a column ``conv_id``; one without rows has zeros and an empty audit. A null
    ``conv_id`` is a conversation.
    """
    names = conversations.select("conv_id").distinct()
    found = conversation_marks(placed).withColumnRenamed("conv_id", "of")
    rows = names.join(found, names["conv_id"].eqNullSafe(found["of"]), "left").select(
        "conv_id", F.coalesce("marks", F.lit("")).alias("marks"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps")
    )
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], T.StructField("audit", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for marks in batch.column("marks").to_pylist():
                initials, faults = marks[::2], marks[1::2]
                illegal = sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))
                found.append((faults.count("b"), faults.count("d"), faults.count("t"), illegal, *cheapest_audit(marks)))
            columns = list(zip(*found)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("gaps"), *arrays], names=schema.names)

    return materialize(rows.mapInArrow(run, schema), "audits")


def _replayed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, int, str | None, str | None]]:
    """(conversation, place, role, text) of repaired rows; place 0 opens each conversation."""
    name, audit, at, state, place = None, "", 0, START, 0

    def inserts() -> Iterator[tuple[object, int, str, str]]:
        nonlocal at, state, place
        while audit[at : at + 1] == "I":
            role, at, place = _inserted(state), at + 1, place + 1
            state = NEXT[state][role]
            yield name, place, ROLES[role], ""

    for batch in batches:
        for conv, is_row, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "is_row", "role", "text")]):
            if not is_row:
                name, audit, at, state, place = conv, text, 0, START, 0
                yield name, 0, None, None
                yield from inserts()
                continue
            letter, at = audit[at], at + 1
            if letter != "D":
                to = _inserted(state) if letter == "R" else role[0]
                state, place = NEXT[state][to], place + 1
                yield name, place, ROLES[to] if letter == "R" else role, text
            yield from inserts()


def _streams(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """An audit and the rows it is about, one conversation behind the other in each task."""
    heads = audits.select("conv_id", F.lit(False).alias("is_row"), F.lit(-1).cast("long").alias("seq"), F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = placed.select("conv_id", F.lit(True).alias("is_row"), "seq", "role", "text")
    small_batches(placed.sparkSession)
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "seq")


def repaired_rows(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations; place counts from 1."""
    schema = T.StructType([placed.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    kind = _arrow_type(placed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in _replayed(batches):
            if row[1]:
                held.append(row)
                size += len(row[3]) + 32
            if size > 4 << 20:
                yield _batch(held, [kind, pa.int64(), pa.string(), pa.string()], schema.names)
                held, size = [], 0
        yield _batch(held, [kind, pa.int64(), pa.string(), pa.string()], schema.names)

    return _streams(placed, audits).mapInArrow(run, schema)


def repaired_digests(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired ``role:text`` lines, joined by line ends."""
    schema = T.StructType([placed.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    kind = _arrow_type(placed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, digest = [], None, None
        for conv, place, role, text in _replayed(batches):
            if not place:
                if digest:
                    held.append((name, digest.hexdigest()))
                name, digest = conv, hashlib.sha256()
            else:
                digest.update((("\n" if place > 1 else "") + f"{role}:{text}").encode())
            if len(held) >= 4096:
                yield _batch(held, [kind, pa.string()], schema.names)
                held = []
        if digest:
            held.append((name, digest.hexdigest()))
        yield _batch(held, [kind, pa.string()], schema.names)

    return _streams(placed, audits).mapInArrow(run, schema)


def _arrow_type(placed: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(placed.schema["conv_id"].dataType)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair, and the digest of the repaired rows.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. ``rows`` has
    conv_id, turn, role and text, no nulls in the last two (``damage`` fills them); ``conversations``
    adds names that have no rows. Equal rows count as repeats of the first. A role that is empty or
    starts with none of s, u and a can only be replaced or deleted. An empty table gives an empty result.
    """
    placed = place_rows(rows)
    audits = audit_conversations(placed, rows if conversations is None else conversations)
    digests = repaired_digests(placed, audits).withColumnRenamed("conv_id", "of")
    return audits.join(digests, audits["conv_id"].eqNullSafe(digests["of"])).drop("of")
