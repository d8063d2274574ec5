import random
import re

import numpy as np
import pytest
import xxhash

from crawlmill.llm.components import connected_components
from crawlmill.llm.simhash import fingerprint, fingerprint_links, simhash_components


def plain_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints, max_bits):
    """Least index reachable, by searching from every row."""
    n, found = len(fingerprints), {}
    for start in range(n):
        if start in found:
            continue
        queue = [start]
        found[start] = start
        while queue:
            i = queue.pop()
            for j in range(n):
                if j not in found and (fingerprints[i] ^ fingerprints[j]).bit_count() <= max_bits:
                    found[j] = start
                    queue.append(j)
    return found


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one TWO", "a b c", "Ä b\x0bc d e É f", "x y z x y z x", "w " * 70000])
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3) % (1 << 64) == plain_fingerprint(text)


def test_documents_equal_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [None, "", "one", "one", "Two words"]
    for _ in range(25):
        base = random.choices(vocabulary, k=random.choice([4, 30, 300]))
        for _ in range(random.choice([1, 2, 5])):
            changed = list(base)
            for _ in range(random.choice([0, 1, 2, 6])):
                changed[random.randrange(len(changed))] = random.choice(vocabulary)
            texts.append(" ".join(changed))
    rows = [(i, t, "x", -1) for i, t in enumerate(texts)] + [(None, "one", "x", 0), (3, "one", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component int").repartition(3)
    prints = [plain_fingerprint(t) for t in texts]
    least = brute_components(prints, 3)
    expected = [(i, f"{prints[i]:016x}", least[i]) for i in range(len(texts))]
    expected += [(None, f"{prints[2]:016x}", least[2]), (3, f"{prints[3]:016x}", least[3])]
    assert sorted(map(tuple, simhash_components(docs).collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("unit", [4096, 7])
def test_links_connect_what_is_near(spark, unit):
    rng = np.random.default_rng(1)
    values = set()
    for base in rng.integers(0, 1 << 63, 30, dtype=np.uint64).tolist() + [0, (1 << 64) - 1]:
        for _ in range(12):
            value = base
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = fingerprint_links(spark.createDataFrame(signed, "fp long"), 3, unit).collect()
    place = {s[0]: i for i, s in enumerate(signed)}
    assert all((values[place[u]] ^ values[place[v]]).bit_count() <= 3 for u, v in links)
    found = connected_components(spark.createDataFrame(links, "u long, v long"))
    groups = {}
    for node, component in found.collect():
        groups.setdefault(component, set()).add(place[node])
    expected = {}
    for i, least in brute_components(values, 3).items():
        expected.setdefault(least, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1300)] + [(5, 7), (5, 5), (None, 5)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(chain + star, "u long, v long").repartition(4)).collect()))
    assert found == {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, 7, *range(1000, 1300)]}


def test_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
