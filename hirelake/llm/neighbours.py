"""Approximate nearest neighbours by collision counting on single projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Neighbours, ratio of the radii of neighbouring rounds, and the chance of missing a near vector.
K, RATIO, MISS = 10, 2.0, 0.05
#: Share of a block that the windows of the first round are about to hold.
FIRST = 0.05
#: Vectors of a block, and bytes of queries that are sent to the tasks at a time.
BLOCK, QUERY_BYTES = 8192, 16 << 20

FOUND = "query_id long, vec_id long, score double"


def plan_hashes(n: int, ratio: float = RATIO, miss: float = MISS) -> tuple[int, int, float]:
    """Projections, collisions that make a candidate, and the width of a window, for blocks of ``n`` vectors.

    p1 and p2 are the chances that vectors at distance 1 and ``ratio`` project into a query-centred window
    of the width that sets them furthest apart. The threshold lies between them; the number of projections
    follows from Hoeffding's bound on missing a near vector and on a share of far ones.
    """
    width = sqrt(8 * ratio * ratio * log(ratio) / (ratio * ratio - 1))
    p1 = erf(width / 2 / sqrt(2))
    p2 = erf(width / 2 / ratio / sqrt(2))
    far = 100.0 / max(n, 200)
    eta = sqrt(log(2 / far) / log(1 / miss))
    alpha = (eta * p1 + p2) / (1 + eta)
    m = int(np.ceil(max(log(1 / miss) / (2 * (p1 - alpha) ** 2), log(2 / far) / (2 * (alpha - p2) ** 2))))
    return m, int(np.ceil(alpha * m)), width


def directions(m: int, size: int) -> np.ndarray:
    """The same normal directions in every task."""
    return np.random.default_rng(size * 1009 + 17).standard_normal((size, m))


class Block:
    """Vectors and, for each projection, their places in its order: the sorted arrays."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.m, self.threshold, self.width = plan_hashes(len(ids))
        self.axes = directions(self.m, vectors.shape[1])
        values = np.ascontiguousarray((self.vectors @ self.axes).T)  # a row for each projection
        self.places = np.argsort(values, axis=1)
        self.sorted = np.take_along_axis(values, self.places, axis=1)
        gaps = np.diff(self.sorted, axis=1)
        positive = gaps[gaps > 0]
        gap = float(np.median(positive)) if len(positive) else 1.0
        self.unit = gap * max(1.0, FIRST * len(ids) / self.width)  # the radius of the first round

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest found, with distances: windows around the query's projections widen round by round,
        each round adding to the collision counts; what passes the threshold is measured. The search ends
        when k measured vectors lie within the round's radius, or all are measured."""
        n = len(self.ids)
        here = query @ self.axes
        counts = np.zeros(n, np.int64)
        measured = np.zeros(n, bool)
        distance = np.full(n, np.inf)
        out = self.ids == own
        measured[out] = True
        radius = self.unit
        left = [int(row.searchsorted(x)) for row, x in zip(self.sorted, here, strict=True)]
        right = left.copy()
        while True:
            half = self.width * radius / 2
            wider = []
            for j, row in enumerate(self.sorted):
                if left[j] > 0:
                    a = int(row.searchsorted(here[j] - half, "left"))
                    wider.append(self.places[j, a : left[j]])
                    left[j] = min(a, left[j])
                if right[j] < n:
                    b = int(row.searchsorted(here[j] + half, "right"))
                    wider.append(self.places[j, right[j] : b])
                    right[j] = max(b, right[j])
            if wider:
                counts += np.bincount(np.concatenate(wider), minlength=n)
            new = np.flatnonzero((counts >= self.threshold) & ~measured)
            if len(new):
                distance[new] = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
                measured[new] = True
            near = int((distance <= radius).sum())
            if near >= k or measured.all():
                break
            radius *= RATIO
        found = np.flatnonzero(np.isfinite(distance))
        best = found[np.lexsort((self.ids[found], distance[found]))[:k]]
        return self.ids[best], distance[best]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of one size each time, BLOCK of them at most."""
    held: dict[int, list] = {}
    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        column = batch.column("v")
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            vectors = flat[starts[rows][:, None] + np.arange(size)]
            kept = held.setdefault(int(size), [])
            kept.append((ids[rows], vectors))
            while sum(len(i) for i, _ in kept) >= BLOCK:
                i, v = np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept])
                yield i[:BLOCK], v[:BLOCK]
                kept[:] = [(i[BLOCK:], v[BLOCK:])]
    for kept in held.values():
        i, v = np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept])
        if len(i):
            yield i, v


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: all components there and finite, not all zero."""
    v = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine).where(F.exists("v", lambda x: x != 0))


def one_each(vectors: DataFrame) -> DataFrame:
    """One vector of each vec_id, of several the smallest; nothing is moved but ids if none is repeated."""
    repeated = vectors.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")
    return vectors if repeated.isEmpty() else vectors.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(queries: DataFrame, vectors: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` nearest found of ``vectors``
    with another vec_id, by Euclidean distance, ties by vec_id. Both have (vec_id, v) as `usable` gives them.

    Vectors stay where they are: a task builds the sorted arrays of the blocks it reads and searches each
    query there. Queries go to the tasks in chunks of QUERY_BYTES at most, so no broadcast grows with them;
    each chunk is one more pass. Every vector is indexed. Per block, k rows a query leave the task, and the
    final ranking keeps k of them before and after the shuffle.

    Only vectors of the same number of components meet. A query with fewer than k candidates gets them all.
    Of several rows of one vec_id the smallest vector takes part, as a query and as a candidate. Empty tables
    give no rows.
    """
    spark = vectors.sparkSession
    queries, vectors = one_each(queries), one_each(vectors)
    count, longest = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    chunks = max(1, -(-count * (8 * (longest or 1) + 64) // QUERY_BYTES))
    parts = []
    for chunk in range(chunks):
        some = queries if chunks == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == chunk)
        rows = some.orderBy("vec_id").collect()  # bounded by QUERY_BYTES
        sent = spark.sparkContext.broadcast(
            (np.array([r[0] for r in rows], np.int64), [np.array(r[1], float) for r in rows])
        )

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, points = sent.value
            for own, found in _blocks(batches):
                block, out = Block(own, found), []
                for q, point in zip(ids, points, strict=True):
                    if len(point) == block.vectors.shape[1]:
                        near, score = block.search(point, q, k)
                        out.append((np.full(len(near), q), near, score))
                if out:
                    a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b), pa.array(c)], ["query_id", "vec_id", "score"])

        parts.append(vectors.mapInArrow(run, FOUND))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return nearest(vectors.where(F.col("vec_id") % 100 == 0), vectors)
