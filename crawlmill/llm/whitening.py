"""Whitening of embeddings by the components of their covariance.

Three passes over the vectors, none of which moves a vector: exact sums, the centred covariance, and the
projection. A task sends one row of sums, or one row per dimension of its share of the covariance; what
reaches the driver is as large as the covariance and does not grow with the rows. Components come from
contour integration (``feast``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.llm.common import list_offsets
from crawlmill.llm.feast import largest_eigenpairs
from crawlmill.session import materialize

SCALE, SHIFT = 1024, 100_000  # fixed values: an entry c becomes floor(SCALE * c) + SHIFT
LARGEST = float(1 << 52)  # entries from here on do not fit a long
HALF = 32


def usable(vector: Column) -> Column:
    """No null, no entry that is null, not finite, or too large for a long."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)), F.lit(False))


def _steps(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """floor(SCALE * c) as int64, one row per vector; missing entries at the end of a vector are zeros."""
    flat, ends = list_offsets(column)
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), lengths.max(initial=0) if width is None else width), dtype=np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(ends[:-1], lengths)] = np.floor(SCALE * flat.astype(np.float64)).astype(np.int64)
    return out


@dataclass(frozen=True)
class Whitening:
    """Number of vectors, sums by dimension, eigenvalues, components (columns), trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float


def _centred(column: pa.ListArray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, exactly: int64 where that fits, else Python's integers."""
    x = _steps(column, len(sums)) + SHIFT
    largest = max(int(np.abs(x).max(initial=0)), max(map(abs, sums), default=0) // max(n, 1) + 1)
    kind = np.int64 if 2 * n * largest < 1 << 62 else object
    return n * x.astype(kind) - np.array(sums, dtype=kind)


def _squares(centred: np.ndarray) -> list[int | None]:
    """Sums of squares; None where a long cannot hold one."""
    largest = int(np.abs(centred).max(initial=0))
    if largest**2 * max(1, centred.shape[1]) >= 1 << 62:
        centred = centred.astype(object)
    sums = (centred * centred).sum(axis=1) if centred.size else np.zeros(len(centred), dtype=np.int64)
    return [int(s) if s < 1 << 63 else None for s in sums]


def exact_sums(vectors: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of vectors, and the sum of x by dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, halves = 0, np.zeros((2, 0), dtype=np.int64)
        for batch in batches:
            steps = _steps(batch.column("vector"))
            n += len(steps)
            parts = np.stack([(steps >> HALF).sum(axis=0), (steps & (1 << HALF) - 1).sum(axis=0)])
            wide = max(halves.shape[1], parts.shape[1])
            halves, parts = (np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in (halves, parts))
            halves = halves + parts
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "high": pa.array([halves[0].tolist()], pa.list_(pa.int64())), "low": pa.array([halves[1].tolist()], pa.list_(pa.int64()))})

    found = vectors.select("vector").mapInArrow(run, "n long, high array<long>, low array<long>")
    parts = found.select("n", F.posexplode_outer(F.arrays_zip("high", "low")).alias("i", "s"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = parts.groupBy("i").agg(exact("s.high").alias("high"), exact("s.low").alias("low"), F.sum("n").alias("n")).collect()
    by_place = {r["i"]: (int(r["high"]) << HALF) + int(r["low"]) for r in rows if r["i"] is not None}
    # Each task has one row at place 0, or one without a place if it saw no entries.
    n = sum(r["n"] for r in rows if not r["i"])
    return n, tuple(by_place[i] + n * SHIFT for i in range(len(by_place)))


def covariance(vectors: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Covariance of x with divisor n; vectors are centred before they are multiplied."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(sums)))
        for batch in batches:
            centred = _centred(batch.column("vector"), n, sums).astype(np.float64) / n
            total += centred.T @ centred
        flat = pa.ListArray.from_arrays(np.arange(len(sums) + 1, dtype=np.int32) * len(sums), total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), flat], names=["i", "row"])

    shares = vectors.select("vector").mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((len(sums), len(sums)))
    for r in shares.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return (out + out.T) / 2 / n


def fit_whitening(vectors: DataFrame, components: int) -> Whitening:
    """The ``components`` largest components of a column ``vector``; fewer where the rank is less."""
    n, sums = exact_sums(vectors)
    found = covariance(vectors, n, sums) if n and sums else np.zeros((0, 0))
    values, columns = largest_eigenpairs(found, components)
    return Whitening(n, sums, values, columns, float(np.trace(found)))


def project(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """(id, deviation, whitened): whitened is one array per vector."""
    scale = fitted.components / np.sqrt(fitted.values) / max(1, fitted.n)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = _centred(batch.column("vector"), fitted.n, fitted.sums)
            white = centred.astype(np.float64) @ scale
            ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(_squares(centred), pa.int64()), pa.ListArray.from_arrays(ends, white.ravel())],
                names=["id", "deviation", "whitened"],
            )

    schema = T.StructType([vectors.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return vectors.mapInArrow(run, schema)


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest entry by which the covariance of the whitened values differs from the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    at = lambda i: F.col("whitened")[i]
    found = projected.agg(*[F.covar_pop(at(i), at(j)) for i, j in pairs]).first()
    return max((abs(v - (i == j)) for v, (i, j) in zip(found, pairs)), default=0.0)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Components count from 1 by falling eigenvalue; there are fewer than ``components`` if the rank is less, and
    none if all vectors are equal. Vectors that are null or hold a null, a non-finite entry or one beyond
    2^52 take no part. A vector that is shorter than others has zeros at its end. A deviation that a long cannot
    hold is null. Rows may share an id or have none. Other columns, whatever their names, are not read. An empty
    table gives an empty result.
    """
    vectors = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(usable(F.col("vector")))
    fitted = fit_whitening(vectors, components)
    projected = project(vectors, fitted)
    error = 0.0
    if len(fitted.values):
        projected = materialize(projected, "whitened")
        error = identity_error(projected, len(fitted.values))
    shares = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values]).cast("array<double>")
    return projected.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
