import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crawlmill.llm.packing import best_fit, pack, text_cluster, word_count


def naive(lengths, sources, clusters, capacity):
    bins, places = [], []
    for piece in zip(lengths, sources, clusters):
        used = [sum(p[0] for p in b) for b in bins]
        fits = [
            i for i, b in enumerate(bins)
            if used[i] + piece[0] <= capacity and used[i] < capacity
            and not any((p[1] is not None and p[1] == piece[1]) or (p[2] is not None and p[2] == piece[2]) for p in b)
        ]
        if fits:
            chosen = max(fits, key=lambda i: (used[i], -i))
        else:
            chosen = len(bins)
            bins.append([])
            used.append(0)
        places.append((chosen, used[chosen]))
        bins[chosen].append(piece)
    return places


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_equals_naive_search(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 30, 300])
    lengths = [rng.choice([1, 5, 20, 50, 100, rng.randint(1, 100)]) for _ in range(n)]
    if seed % 2:
        lengths.sort(reverse=True)
    sources = [rng.choice([None, "hot", "hot", *"abcdefgh"]) for _ in range(n)]
    clusters = [rng.choice([None, rng.randint(0, 40)]) for _ in range(n)]
    assert best_fit(lengths, sources, clusters, 100) == naive(lengths, sources, clusters, 100)


def documents(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([3, 40, 99, 100, 101, 250]), "hot" if i % 3 == 0 else f"s{i % 17}", str(i % 50), "x") for i in range(900)]
    rows += [(900, 0, "a", "e", "x"), (901, None, "a", "e", "x"), (902, 5, None, None, "x"), (None, 7, "a", None, "x"), (950, 40, "hot", "3", "x"), (950, 40, "hot", "3", "x"), (903, 50_000, "b", "b", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, n_words long, source string, cluster string, bin_id string").repartition(5)


def test_every_word_is_packed_once_without_conflicts(spark):
    rows, docs = documents(spark)
    found = pack(docs, 100, shard=128).collect()
    assert found[0].__fields__ == ["doc_id", "source", "piece", "start", "n_words", "bin_id", "offset"]
    clusters = {r[0]: r[3] for r in rows}
    bins, words = defaultdict(list), defaultdict(list)
    for r in found:
        words[r.doc_id].append((r.start, r.n_words))
        if r.n_words:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None
    for doc_id, total, *_ in rows:
        if doc_id != 950:  # stands twice
            at = 0
            for start, length in sorted(words[doc_id]):
                assert start == at
                at += length
            assert at == (total or 0)
    assert words[950] == [(0, 40), (0, 40)]
    shards = defaultdict(list)
    for bin_id, held in bins.items():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_words
            shards[bin_id >> 32].append((r, clusters[r.doc_id]))
        assert at <= 100
        known = [r.source for r in held if r.source]
        assert len(known) == len(set(known))
        known = [clusters[r.doc_id] for r in held if clusters[r.doc_id]]
        assert len(known) == len(set(known))
    assert len(shards) > 4
    for pieces in shards.values():
        pieces.sort(key=lambda p: (-p[0].n_words, p[0].doc_id is None, p[0].doc_id or 0, p[0].piece, p[0].bin_id))
        places = naive([p.n_words for p, _ in pieces], [p.source for p, _ in pieces], [c for _, c in pieces], 100)
        assert sorted(offset for _, offset in places) == sorted(p.offset for p, _ in pieces)
        assert len({b for b, _ in places}) == len({p.bin_id for p, _ in pieces})


def test_empty_table(spark):
    assert pack(documents(spark)[1].limit(0), 100).collect() == []


def test_lengths_and_clusters(spark):
    docs = spark.createDataFrame([(None,), ("",), (" A  b\n",), ("a B",)], "text string")
    found = docs.select(word_count(F.col("text")), text_cluster(F.col("text"))).collect()
    assert [r[0] for r in found] == [0, 0, 2, 2]
    assert found[0][1] == found[1][1] != found[2][1] == found[3][1]
