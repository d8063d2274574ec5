import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlmill.llm.neighbours import balanced_parts, learn, nearest, nearest_neighbours, neighbour_graph

SCHEMA = "vec_id long, embedding array<float>, id string, vector int"


def brute(rows, k, asks):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 4:
            usable.setdefault(i, set()).add(tuple(float(np.float32(x)) for x in v))
    out = []
    for i, own in usable.items():
        if not asks(i):
            continue
        found = set()
        for q in own:
            for j, others in usable.items():
                found |= {(j, q, o) for o in others if j != i}
        scored = set()
        for j, q, o in found:
            total = 0.0
            for a, b in zip(q, o):
                total += a * b
            scored.add((-total, j))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_small_table_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(160)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 0.0, 0.0]), (220, [float("inf"), 1.0, 0.0, 0.0]), (240, []), (260, [1.0, 2.0]), (None, [1.0] * 4)]
    rows += [rows[5], rows[20], (7, [1.0, 1.0, 1.0, 1.0])] + [(i, [2.0, 0.0, 1.0, 0.0]) for i in range(300, 360)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    found = nearest_neighbours(table, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 20, lambda i: i % 20 == 0)


def test_fewer_candidates_than_k_and_no_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found = sorted(map(tuple, nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect()))
    assert found == [(0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]
    assert nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest_neighbours(table, F.col("vec_id") == 99).collect() == []


def test_blocks_find_equal_vectors_by_smallest_id():
    rng = np.random.default_rng(3)
    vectors = np.vstack((rng.standard_normal((50, 8)), np.tile(rng.standard_normal(8), (400, 1))))
    ids = rng.permutation(450)
    q, i, s = nearest(ids[:60], vectors[:60], ids, vectors, 20)
    scores = np.zeros((60, 450))
    for d in range(8):
        scores += vectors[:60, d][:, None] * vectors[:, d][None, :]
    for row in range(60):
        expected = sorted((-scores[row, c], ids[c]) for c in range(450) if ids[c] != ids[row])[:20]
        assert [(-b, a) for a, b in zip(i[q == ids[row]], s[q == ids[row]])] == expected


def mixture(count, dim, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((60, dim))
    rows = centres[rng.integers(0, 60, count)] + 0.3 * rng.standard_normal((count, dim))
    rows[: count // 3] = rows[0]
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_parts_are_balanced_and_keep_neighbours_together():
    vectors = mixture(2000, 16)
    graph = neighbour_graph(vectors[700:], 10)
    part = balanced_parts(graph, 8)
    sizes = np.bincount(part)
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 3
    assert np.mean(part[graph] == part[:, None]) > 0.7


@pytest.fixture(scope="module")
def learned(spark):
    vectors = mixture(12000, 16).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    return vectors, spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)


def test_recall_with_several_parts(spark, learned):
    vectors, table = learned
    found = nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect()
    wide = vectors.astype(np.float64)
    router = learn(wide[np.random.default_rng(0).permutation(12000)[:8192]], 12000)
    assert router.output.shape[1] == 4
    hits = 0
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q in range(0, 12000, 20):
        scores = np.zeros(12000)
        for d in range(16):
            scores += wide[:, d] * wide[q, d]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(12000), -scores))[:20]
        mine = sorted(got[q])
        assert [rank for rank, _ in mine] == list(range(1, 21))
        hits += len(set(best.tolist()) & {i for _, i in mine})
    assert hits / (600 * 20) >= 0.9
