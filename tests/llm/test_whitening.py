import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlmill.llm.feast import count_above, largest_eigenpairs
from crawlmill.llm.whitening import exact_sums, whiten

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def symmetric(values, seed=1):
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    return (basis * values) @ basis.T


SPECTRA = {
    "spread": np.geomspace(1e6, 1e-3, 40),
    "close": np.concatenate([100 + np.arange(12) * 1e-4, np.ones(20)]),
    "equal": np.repeat([50.0, 7.0, 3.0], 6),
    "low rank": np.concatenate([[9.0, 4.0, 1.0], np.zeros(30)]),
    "one large": np.concatenate([[1e9], np.linspace(1, 2, 63)]),
    "small": np.array([3.0, 2.0]),
    "zero": np.zeros(5),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_eigenpairs_equal_a_dense_solver(name):
    matrix = symmetric(SPECTRA[name])
    matrix = (matrix + matrix.T) / 2
    values, vectors = largest_eigenpairs(matrix, 8)
    expected = np.sort(SPECTRA[name])[::-1][:8]
    expected = expected[expected > 0]
    top = expected.max(initial=1.0)
    assert np.allclose(values, expected, rtol=0, atol=1e-13 * len(matrix) * top)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) < 1e-13 * len(matrix) * top


def test_inertia_counts():
    for seed in range(20):
        values = np.random.default_rng(seed).integers(-5, 6, 17).astype(float)
        matrix = symmetric(values, seed)
        for shift in (-4.5, -0.5, 0.5, 3.5):
            assert count_above(matrix, shift) == (values > shift).sum()
    assert count_above(np.array([[0.0, 2.0], [2.0, 0.0]]), 0.0) == 1


def brute(rows):
    rows = [(i, [np.float32(c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return [i for i, _ in rows], n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(cov)


@pytest.fixture(scope="module")
def given():
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((700, 20)) @ draw.standard_normal((20, 20)) + 5
    rows = [(i, v.astype(np.float32).tolist(), "c", "n") for i, v in enumerate(vectors)]
    rows += [(None, rows[3][1], None, None), (3, rows[3][1], "", "")] + [(2000 + i, rows[8][1], "", "") for i in range(300)]
    odd = [(900, None), (901, [None] * 20), (902, [float("nan")] + [0.0] * 19), (903, [float("-inf")] + [0.0] * 19)]
    return rows + [(i, v, "x", "x") for i, v in odd]


def test_result_equals_brute_force(spark, given):
    found = whiten(spark.createDataFrame(given, SCHEMA).repartition(7))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    ids, n, deviation, white, shares = brute([r[:2] for r in given])
    rows = found.toPandas()
    assert len(rows) == 8 * len(ids) and set(rows["n"]) == {n} and rows["identity_error"].max() < 1e-9
    signs = {}
    expected = sorted(((-1 if i is None else i), k + 1, d, w[k]) for i, d, w in zip(ids, deviation, white) for k in range(8))
    got = sorted(zip(rows["vec_id"].fillna(-1).astype(int), rows["component"], rows["deviation"], rows["whitened"], rows["explained"]))
    for (i, k, d, w), (j, c, e, v, share) in zip(expected, got):
        sign = signs.setdefault(k, np.sign(w * v))
        assert (i, k, d) == (j, c, e) and abs(w - sign * v) < 1e-8 and abs(share / shares[k - 1] - 1) < 1e-9


def test_deviation_beyond_a_long_and_large_entries(spark):
    rows = [(i, [float(2.0 ** (40 + i % 3)), float(i)], "", "") for i in range(50)]
    n, sums = exact_sums(spark.createDataFrame(rows, SCHEMA).select(F.col("embedding").alias("vector")))
    assert n == 50 and sums[0] == sum(1024 * 2 ** (40 + i % 3) + 100000 for i in range(50))
    found = whiten(spark.createDataFrame(rows, SCHEMA))
    # The second component is at rounding level beside the first.
    assert found.filter("deviation is null").count() == found.count() == 50
    assert found.first()["identity_error"] < 1e-4


def test_empty_equal_and_short_vectors(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, "", "")], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, [0.5, 1.0], "", ""), (2, [0.5, 1.0], "", "")], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, [], "", "")], SCHEMA)).collect() == []
    short = whiten(spark.createDataFrame([(1, [1.0, 0.0], "", ""), (2, [], "", ""), (3, [0.0, 2.0], "", "")], SCHEMA))
    assert short.count() == 6 and {r["n"] for r in short.collect()} == {3}
