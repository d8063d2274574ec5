"""Approximate nearest neighbours by largest inner product, over learned partitions.

On a bounded sample an exact neighbour graph is built and cut into equal parts with few edges
between them. A small classifier learns in which parts a vector's neighbours lie. It puts every row
of the table into its most probable part, and sends a query to as many of the most probable parts as
the sample needs for the wanted share of its neighbours. There the query meets all rows of the part,
in blocks, and exact inner products decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlmill.session import materialize

SAMPLE = 8192  # vectors at most that the partition is learned on
GRAPH_DEGREE = 12
ROWS_PER_PART = 2048
MOST_PARTS = 256
TARGET = 0.95  # share of the sample's neighbours within the parts visited
BLOCK = 4096  # candidates, or queries, that a task holds at once
QUERY_STEP = 128


def usable(vector: Column) -> Column:
    """Neither null, zero nor empty, with finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbour_graph(vectors: np.ndarray, degree: int) -> np.ndarray:
    """Row numbers of the ``degree`` nearest others of each row."""
    count = len(vectors)
    degree = min(degree, count - 1)
    found = np.empty((count, degree), dtype=np.int64)
    for at in range(0, count, 1024):
        near = vectors[at : at + 1024] @ vectors.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        found[at : at + 1024] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return found


def _halves(count: int, u: np.ndarray, v: np.ndarray, rng: np.random.Generator, rounds: int = 60) -> np.ndarray:
    """Two equal halves of a graph (both directions of each edge given) with few edges between.

    The median of a slow mode of the random walk splits; exchanges of the pairs with most gain refine.
    """
    degree = np.bincount(u, minlength=count) + 1e-9
    mode = rng.standard_normal(count)
    for _ in range(rounds):
        mode -= (mode * degree).sum() / degree.sum()
        mode = 0.5 * (mode + np.bincount(u, weights=mode[v], minlength=count) / degree)
        mode /= np.abs(mode).max() + 1e-300
    side = np.zeros(count, dtype=bool)
    side[np.argsort(mode, kind="stable")[count // 2 :]] = True
    for _ in range(10):
        gain = np.bincount(u, weights=np.where(side[u] != side[v], 1.0, -1.0), minlength=count)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        pairs = min(len(left), len(right))
        better = int(np.count_nonzero(gain[left[:pairs]] + gain[right[:pairs]] > 2)) // 2
        if not better:
            break
        side[left[:better]], side[right[:better]] = True, False
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """Part of each row; ``parts`` is a power of two and sizes differ by one per cut at most."""
    count = len(graph)
    u = np.concatenate((np.repeat(np.arange(count), graph.shape[1]), graph.ravel()))
    v = np.concatenate((graph.ravel(), np.repeat(np.arange(count), graph.shape[1])))
    part = np.zeros(count, dtype=np.int64)
    rng = np.random.default_rng(seed)
    for _ in range(int(math.log2(parts))):
        cut = part.copy()
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            place = np.full(count, -1)
            place[rows] = np.arange(len(rows))
            inner = (place[u] >= 0) & (place[v] >= 0)
            cut[rows] = 2 * p + _halves(len(rows), place[u[inner]], place[v[inner]], rng)
        part = cut
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer that gives the parts of vectors, most probable first."""

    hidden: np.ndarray
    output: np.ndarray
    probes: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        inner = np.maximum(_with_one(vectors) @ self.hidden, 0.0)
        return _with_one(inner) @ self.output

    def parts(self, vectors: np.ndarray, count: int) -> np.ndarray:
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")[:, :count]


def _with_one(rows: np.ndarray) -> np.ndarray:
    return np.hstack((rows, np.ones((len(rows), 1))))


def learn_router(vectors: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, width: int = 128, epochs: int = 30, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Weights that predict the parts of a vector and of its neighbours (Adam on cross-entropy)."""
    rng = np.random.default_rng(seed)
    target = np.zeros((len(vectors), parts))
    np.add.at(target, (np.repeat(np.arange(len(vectors)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    target[np.arange(len(vectors)), part] += 0.5
    inputs = _with_one(vectors)
    scale = np.sqrt(np.mean(np.square(vectors)) * inputs.shape[1]) + 1e-12
    weights = [rng.standard_normal((inputs.shape[1], width)) / scale, np.zeros((width + 1, parts))]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(vectors))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            inner = np.maximum(inputs[rows] @ weights[0], 0.0)
            wide = _with_one(inner)
            logits = wide @ weights[1]
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (chance / chance.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (error @ weights[1][:-1].T) * (inner > 0)
            step += 1
            for w, (m, s), g in zip(weights, moments, (inputs[rows].T @ back, wide.T @ error)):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return weights[0], weights[1]


def learn(vectors: np.ndarray, rows: int, target: float = TARGET) -> Router:
    """The router for a table of ``rows`` vectors, learned on a sample of them."""
    most = min(MOST_PARTS, rows // ROWS_PER_PART, len(vectors) // 32)
    parts = 1 << int(math.log2(most)) if most > 1 else 1
    width = vectors.shape[1] if len(vectors) else 0
    if parts == 1:
        return Router(np.zeros((width + 1, 1)), np.zeros((2, 1)), 1)
    scale = np.linalg.norm(vectors, axis=1).mean()
    graph = neighbour_graph(vectors, GRAPH_DEGREE)
    hidden, output = learn_router(vectors / scale, graph, balanced_parts(graph, parts), parts)
    hidden[:-1] /= scale
    router = Router(hidden, output, parts)
    order = router.parts(vectors, parts)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    ranks = np.take_along_axis(place, order[graph, 0], axis=1)  # of each neighbour's part, for its query
    for probes in range(1, parts + 1):
        if np.mean(ranks < probes) >= target:
            break
    return Router(hidden, output, probes)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the k nearest of each query, its own id left out.

    Of equal vectors only the k + 1 smallest ids can be among the nearest.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    distinct, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.ravel()
    by_group = np.argsort(group, kind="stable")
    nth = np.arange(len(ids)) - np.searchsorted(group[by_group], group[by_group])
    kept = np.sort(by_group[nth <= k])
    ids, vectors = ids[kept], vectors[kept]
    slack = 1e-12 * np.abs(vectors).max(initial=0) * vectors.shape[1]
    out = []
    for at in range(0, len(queries), QUERY_STEP):
        mine, my_ids = queries[at : at + QUERY_STEP], query_ids[at : at + QUERY_STEP]
        near = mine @ vectors.T
        near[my_ids[:, None] == ids[None, :]] = -np.inf
        least = np.partition(near, -k, axis=1)[:, -k] if near.shape[1] > k else np.full(len(mine), -np.inf)
        margin = slack * np.abs(mine).max(axis=1)
        q, c = np.nonzero((near >= (least - margin)[:, None]) & (near > -np.inf))
        score = exact_scores(mine[q], vectors[c])
        best = np.lexsort((ids[c], -score, q))
        q, c, score = q[best], c[best], score[best]
        first = np.arange(len(q)) - np.searchsorted(q, q) < k
        out.append((my_ids[q[first]], ids[c[first]], score[first]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def nearest_neighbours(
    rows: DataFrame,
    query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
    target: float = TARGET,
) -> DataFrame:
    """(query_id, rank, id, score): for each row that ``query`` (a condition) picks, its k nearest.

    Candidates are all rows but those with the query's own id. Score is the inner product in double
    precision, added in the order of the components; ties go to the smaller id. Rows with a null
    id, and vectors that are null, empty, zero or hold null or non-finite components, take no part;
    neither do vectors of another length than the most frequent one. Repeated rows count once. With
    fewer candidates than k in the parts visited, the query gets these. Other columns are not read.
    An empty table gives an empty result.

    The sample (the least id hashes) and the weights are bounded. A part with many rows is cut into blocks by an id
    hash, and so are its queries; each pair of blocks is a task of its own, so equal vectors or a
    crowded part never make a large task. A task sends k rows per query on.
    """
    vectors = rows.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(query, F.lit(False)).alias("asks"),
    )
    sizes = vectors.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim, count = (sizes[0].dim, sizes[0]["count"]) if sizes else (1, 0)
    vectors = vectors.filter(F.size("vector") == dim)
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    router = learn(np.array([r.vector for r in picked], dtype=np.float64).reshape(-1, dim), count, target)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = router.parts(_matrix(batch.column("vector"), dim), router.probes)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(parts[:, 0], pa.int32()),
                 pa.array([p if a else None for p, a in zip(parts.tolist(), asks)], pa.list_(pa.int32()))],
                ["id", "vector", "part", "visits"],
            )

    routed = materialize(vectors.mapInArrow(route, "id long, vector array<double>, part int, visits array<int>"), "routed")
    asking = routed.select("id", "vector", F.explode("visits").alias("part"))
    # One row per part: at most MOST_PARTS.
    held = routed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    asked = asking.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("askers"))
    plan = F.broadcast(materialize(held.join(asked, "part"), "blocks"))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    candidates = routed.drop("visits").join(plan, "part").select(
        "id", "vector", "part", mine("blocks").alias("block"), every("askers").alias("asker")
    )
    asking = asking.join(plan, "part").select(
        "id", "vector", "part", every("blocks").alias("block"), mine("askers").alias("asker")
    )

    def search(queries: pa.Table, found: pa.Table) -> pa.Table:
        if not queries.num_rows or not found.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        result = nearest(
            queries.column("query_id").to_numpy(), _matrix(queries.column("query"), dim),
            found.column("id").to_numpy(), _matrix(found.column("vector"), dim), k,
        )
        return pa.table(dict(zip(("query_id", "id", "score"), result)))

    keys = ["part", "block", "asker"]
    asking = asking.toDF("query_id", "query", *keys)  # columns of their own for the cogroup
    near = asking.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(search, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = near.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
