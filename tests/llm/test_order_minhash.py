import hashlib
import random

import numpy as np
import pytest

from crawlmill.llm.order_minhash import KMER, LENGTH, PLACE_BITS, SKETCHES, OrderMinHash, compare_with_next, fingerprints, likeness

SCHEMA = "doc_id long, text string, part string, fingerprint int"
MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


BASE = 0x9E3779B97F4A7C15


def brute(text):
    """The definition: least occurrence-numbered k-mers of each function, in text order."""
    size = min(KMER, len(text))
    bits, seen, kmers = max(PLACE_BITS, len(text).bit_length()), {}, []
    for place in range(len(text) - size + 1) if text else ():
        value = 0
        for c in text[place : place + size]:
            value = (value * BASE + ord(c) + 1) & MASK
        kmer = mixed(value) >> bits
        seen[kmer] = seen.get(kmer, 0) + 1
        kmers.append((((kmer + seen[kmer] * BASE) * 0xBF58476D1CE4E5B9 & MASK) >> 32, kmer, place))
    out = b""
    for factor in OrderMinHash()._factors[:, 0].tolist():
        least = sorted((rank * factor & 0xFFFFFFFF, kmer, place) for rank, kmer, place in kmers)[:LENGTH]
        entry = 0
        for _, kmer, _ in sorted(least, key=lambda x: x[2]):
            entry = mixed((entry * BASE + kmer + 1) & MASK)
        out += (entry >> 32).to_bytes(4, "big")
    return out


ODD = ["", "a", "abc", "ab" * 40, "aaaaaaaaaaaaaaaaaaaa", "naïve ✓ 𝄞 text ퟿", "x" * 9, "one two three four five six seven " * 60]


@pytest.mark.parametrize("text", ODD)
def test_fingerprint_equals_its_definition(text):
    assert OrderMinHash().fingerprint(text) == brute(text)


def test_texts_longer_than_a_step():
    draw = random.Random(1)
    text = "".join(draw.choice("abcdef ") for _ in range(7000))
    assert OrderMinHash().fingerprint(text) == brute(text)


def test_likeness_follows_edits_and_order():
    draw, scheme = random.Random(3), OrderMinHash()
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    text = " ".join(words)
    near = []
    for share in (0, 5, 20, 50, 100):
        changed = [draw.choice(words)[::-1] if draw.random() * 100 < share else w for w in words]
        near.append(likeness(scheme.fingerprint(text), scheme.fingerprint(" ".join(changed))))
    assert near[0] == 1 and near == sorted(near, reverse=True) and near[1] > 0.5 and near[-1] < 0.1
    swapped = " ".join(words[200:] + words[:200])
    assert likeness(scheme.fingerprint(text), scheme.fingerprint(swapped)) < 0.75


def expected(rows):
    scheme = OrderMinHash()
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (name, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        own, other, theirs = (scheme.fingerprint(x) for x in (text, changed, following))
        same = [np.mean([own[i : i + 4] == x[i : i + 4] for i in range(0, 4 * SKETCHES, 4)]) for x in (other, theirs)]
        out.append((name, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), other.hex(), *map(float, same)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 6])
def test_result_equals_brute_force(spark, parts):
    draw = random.Random(4)
    rows = [(i, "".join(draw.choice("abc d") for _ in range(draw.randrange(120)))) for i in draw.sample(range(1000), 90)]
    rows += [(2000 + i, t) for i, t in enumerate(ODD[:6])] + [(None, "no id at all"), (3000, None), (3001, "same"), (3002, "same"), (3003, "same"), (4000, "long text, " * 30000)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", str(parts == 1).lower())  # without it, ranges are not merged
    try:
        docs = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA).repartition(parts)
        found = sorted((tuple(r) for r in compare_with_next(docs).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert found == expected(rows)


def test_one_row_repeated_rows_and_empty_tables(spark):
    assert compare_with_next(spark.createDataFrame([], SCHEMA)).collect() == []
    one = compare_with_next(spark.createDataFrame([(1, "just one text here", "", 0)], SCHEMA))
    assert [tuple(r) for r in one.collect()] == expected([(1, "just one text here")])
    rows = [(1, "a text that is here twice"), (1, "a text that is here twice"), (1, "and another one"), (None, "x")]
    found = compare_with_next(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "1", "None"]
    assert len({r["fingerprint"] for r in found}) == 3


def test_fingerprints_alone(spark):
    docs = spark.createDataFrame([(1, "equal", "", 0), (2, "equal", "", 0), (3, None, "", 0)], SCHEMA)
    found = dict(map(tuple, fingerprints(docs).collect()))
    assert found == {1: brute("equal").hex(), 2: brute("equal").hex(), 3: brute("").hex()}
