import hashlib
import itertools
import random
import re
import zlib

import pytest

from crawlmill.llm.conversations import audit_conversations, cheapest_audit, damage, place_rows, repair_conversations, repaired_rows

SCHEMA = "conv_id long, turn long, role string, text string, audit string, seq int"
SHAPE = re.compile(r"(s?(ua)+)?")


def brute_audit(marks):
    """Cost, audit and roles of the best of all edits with at most two inserts in a gap."""
    rows = [marks[i : i + 2] for i in range(0, len(marks), 2)]
    gaps = [()] + [(x,) for x in "ua"] + list(itertools.product("ua", repeat=2))
    choices = [[[("I", x, 5) for x in g] for g in gaps]]
    for initial, fault in rows:
        edits = [[("D", "", 2)]]
        if fault not in "bd":
            more = 5 * (fault == "t")
            edits += [[("K", initial, more)], [("R", "u", 1 + more)], [("R", "a", 1 + more)]]
        choices += [edits, choices[0]]
    best = None
    for path in itertools.product(*choices):
        steps = [x for part in path for x in part]
        if SHAPE.fullmatch("".join(x[1] for x in steps)):
            found = (sum(x[2] for x in steps), "".join(x[0] for x in steps))
            best = min(best or found, found)
    return best


@pytest.mark.parametrize("size", [0, 1, 2])
def test_audit_is_the_least_of_all_edits(size):
    kinds = ["".join(x) for x in itertools.product("suao", "-tb")] + ["sd"]
    for marks in itertools.product(kinds, repeat=size):
        assert cheapest_audit("".join(marks)) == brute_audit("".join(marks)), marks


def test_audit_of_longer_conversations_equals_brute_force():
    chosen = random.Random(1)
    for _ in range(12):
        marks = "".join(chosen.choice(["s-", "u-", "a-", "u-", "a-", "ut", "at", "ab", "od"]) for _ in range(3))
        assert cheapest_audit(marks) == brute_audit(marks), marks


def plain_audit(marks):
    """Whole audits kept as strings: least (cost, audit) from each row and state, without integers."""
    rows = [marks[i : i + 2] for i in range(0, len(marks), 2)]
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    dead = (1 << 50, "~")
    def with_inserts(base):
        now = base
        for _ in range(3):
            now = {s: min([base[s]] + [(now[to][0] + 5, "I" + now[to][1]) for r, to in step[s].items() if r != "s"]) for s in step}
        return now
    best = with_inserts({"": (0, ""), "a": (0, ""), "s": dead, "u": dead})
    for initial, fault in reversed(rows):
        base = {}
        for s in step:
            found = [(best[s][0] + 2, "D" + best[s][1])]
            if fault not in "bd":
                more = 5 * (fault == "t")
                found += [(best[to][0] + more, "K" + best[to][1]) for r, to in step[s].items() if r == initial]
                found += [(best[to][0] + 1 + more, "R" + best[to][1]) for r, to in step[s].items() if r != "s"]
            base[s] = min(found)
        best = with_inserts(base)
    return best[""]


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_blocks_of_any_size_give_the_same_audit(block):
    chosen = random.Random(block)
    for _ in range(200):
        marks = "".join(chosen.choice("suaauao") + chosen.choice("---tbd") for _ in range(chosen.randrange(12)))
        assert cheapest_audit(marks, block) == plain_audit(marks), marks


def test_a_conversation_of_many_thousand_rows():
    chosen = random.Random(3)
    marks = "".join(chosen.choice("suao") + chosen.choice("--tb") for _ in range(20_000))
    cost, audit = cheapest_audit(marks)
    assert len(audit.replace("I", "")) == 20_000 and 0 < cost < 40_000
    assert cost == plain_cost(marks)


def plain_cost(marks):
    far = {"": 0, "s": 1 << 50, "u": 5, "a": 0}
    far["s"] = 10
    for initial, fault in reversed([marks[i : i + 2] for i in range(0, len(marks), 2)]):
        base = {}
        for s, options in {"": "su", "s": "u", "u": "a", "a": "u"}.items():
            found = [far[s] + 2]
            if fault not in "bd":
                more = 5 * (fault == "t")
                found += [far[r] + more for r in options if r == initial] + [far[r] + 1 + more for r in options if r != "s"]
            base[s] = min(found)
        once = {s: min(base[s], 5 + base["a" if s == "u" else "u"]) for s in base}
        far = {s: min(base[s], 5 + once["a" if s == "u" else "u"]) for s in base}
    return far[""]


BLANKS = " \t\n\x0b\x0c\r"


def brute(rows):
    """The contract in plain Python: rows (conv_id, turn, role, text)."""
    sent = lambda x: " " if x is None else str(x)
    out = []
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r[:4] for r in rows if r[0] == conv]:
            role, text = sent(role), sent(text)
            kind = zlib.crc32(f"{sent(conv)}:{sent(turn)}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks = set(), ""
        for _, role, text in kept:
            bare = text.rstrip(BLANKS)
            fault = "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            marks += (role[0] if role[:1] in list("sua") else "o") + fault
        cost, audit = plain_audit(marks)
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        lines, at = [], iter(kept)
        for letter in audit:
            wanted = "assistant" if len(lines) - bool(lines and lines[0][0].startswith("s")) & 1 else "user"
            if letter == "I":
                lines.append((wanted, ""))
            else:
                _, role, text = next(at)
                if letter != "D":
                    lines.append((wanted if letter == "R" else role, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, *(marks[1::2].count(x) for x in "bdt"), illegal, cost, audit, digest))
    return sorted(out, key=str)


def test_result_equals_brute_force(spark):
    chosen = random.Random(5)
    texts = ["Well.", "well", "so? \n", "", " \t", None, "ß!", "next\x85", "a.b", " ", "Long. " * 4000 + "end"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown", "User"]
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(chosen.randrange(1, 9)):
            rows.append((conv, chosen.choice([None, *range(6)]), chosen.choice(roles), chosen.choice(texts), "x", 1))
    rows += rows[:9]
    found = repair_conversations(damage(spark.createDataFrame(rows, SCHEMA).repartition(5)), spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_repaired_rows_follow_the_shape(spark):
    chosen = random.Random(7)
    rows = [(c, t, chosen.choice(["system", "user", "assistant"]), chosen.choice(["A.", "B!", "C", ""]), "", 0) for c in range(30) for t in range(6)]
    placed = place_rows(damage(spark.createDataFrame(rows, SCHEMA)))
    audits = audit_conversations(placed, spark.createDataFrame(rows, SCHEMA))
    lines = {}
    for conv, place, role, text in sorted(tuple(r) for r in repaired_rows(placed, audits).collect()):
        assert place == len(lines.setdefault(conv, [])) + 1
        lines[conv].append((role, text))
    assert all(SHAPE.fullmatch("".join(r[0] for r, _ in x)) for x in lines.values())


def test_names_without_rows_and_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(damage(empty)).collect() == []
    names = spark.createDataFrame([(5,), (None,)], "conv_id long")
    nothing = hashlib.sha256(b"").hexdigest()
    found = repair_conversations(damage(empty), names).collect()
    assert sorted((tuple(r) for r in found), key=str) == [(5, 0, 0, 0, 0, 0, 0, "", nothing), (None, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_a_hot_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Text {t % 700}.", "", 0) for t in range(3000)]
    rows += [(c, 0, "user", "Hi.", "", 0) for c in range(2, 3002)]
    found = repair_conversations(damage(spark.createDataFrame(rows, SCHEMA).repartition(6)), spark.createDataFrame(rows, SCHEMA))
    expected = [r for r in brute([r for r in rows if r[0] < 4])]
    assert sorted((tuple(r) for r in found.filter("conv_id < 4").collect()), key=str) == expected
    assert found.count() == 3001
