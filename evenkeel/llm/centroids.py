"""Exact centroid clustering of whole-number vectors with Ptolemaic lower bounds.

For four points of a Euclidean space Ptolemy's inequality holds, so with two
pivots p and s the distance of a vector v to a centroid c is at least
``|d(v,p) d(c,s) - d(v,s) d(c,p)| / d(p,s)``.  The pivots are fixed, so each
vector's distances to them are computed once and stored beside it; a round only
computes those of the few centroids.  The largest bound of all pivot pairs,
rounded down by more than the error of its arithmetic, rules a centroid out
when it is above the best distance found; all others are checked with exact
integers, ties included.  A round is one pass over the stored vectors, and only
sums for each cluster leave it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import column
from evenkeel.sources.workspace import written

#: The first vectors in the order of their hashes, of which pivots are chosen.
PIVOT_SAMPLE = 64
#: Whole numbers below this have squared distances, of up to 512 components, that fit 64 bits.
SMALL = 1 << 26
#: More than the relative error that double arithmetic makes in a bound.
SLACK = 1e-12
#: Sums travel as digits of this many bits, so that Spark adds them up without overflow.
DIGIT_BITS = 40
LARGEST = (1 << 63) - 1


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, exact: 64-bit numbers if all are small, else Python's. ``scale`` is a power of two."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * x)
    if not scaled.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    exact = [int(v) * scale if abs(v) >= 2.0**53 else int(s) for v, s in zip(x.ravel().tolist(), scaled.ravel().tolist(), strict=True)]
    return np.array(exact, object).reshape(x.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to ``b``, exact."""
    apart = a - b
    if apart.dtype == object:
        return (apart * apart).sum(axis=1) if len(apart) else np.zeros(0, object)
    return np.einsum("ij,ij->i", apart, apart)


def roots(a: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances, as doubles, of the rows of ``a`` to each of ``points``."""
    found = [_doubles(squared(a, p)) for p in points]
    return np.sqrt(np.stack(found, axis=1)) if found else np.zeros((len(a), 0))


def _doubles(x: np.ndarray) -> np.ndarray:
    if x.dtype != object:
        return x.astype(np.float64)
    return np.array([float(v) if v.bit_length() < 1024 else np.inf for v in x], np.float64)


@dataclass(frozen=True)
class Index:
    """Fixed pivots (whole numbers) and the pairs of them that are apart, with their distance."""

    pivots: np.ndarray
    pairs: list[tuple[int, int, float]]

    @classmethod
    def of(cls, sample: np.ndarray, n: int) -> Index:
        """``n`` pivots of the sample, each as far as possible from those before it."""
        chosen: list[int] = []
        apart = np.full(len(sample), np.inf)
        while len(chosen) < n and len(sample) and apart.max() > 0:
            chosen.append(int(np.argmax(apart)))
            apart = np.minimum(apart, _doubles(squared(sample, sample[chosen[-1]])))
        pivots = sample[chosen]
        between = roots(pivots, pivots)
        pairs = [(p, s, between[p, s]) for p, s in combinations(range(len(chosen)), 2) if 0 < between[p, s] < np.inf]
        return cls(pivots, pairs)

    def bounds(self, to_pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """For each vector (by its distances to the pivots) and centroid a number not above their squared distance."""
        of_centroid = roots(centroids, self.pivots)
        low = np.zeros((len(to_pivots), len(centroids)))
        with np.errstate(over="ignore", invalid="ignore"):
            for p, s, between in self.pairs:
                x = to_pivots[:, p, None] * of_centroid[:, s]
                y = to_pivots[:, s, None] * of_centroid[:, p]
                np.fmax(low, (np.abs(x - y) - SLACK * (x + y)) / between, out=low)
            low *= 1 - SLACK
            return low * low

    def nearest(self, vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The number of each vector's nearest centroid (of equals the smallest), the squared distance, and how many were computed."""
        low = self.bounds(to_pivots, centroids)
        low[~np.isfinite(low)] = 0
        cluster = low.argmin(axis=1) if len(low) else np.zeros(0, np.int64)
        best, computed = squared(vectors, centroids[cluster]), len(vectors)
        first = cluster.copy()
        for c in range(len(centroids)):
            rows = np.flatnonzero((low[:, c] * (1 - SLACK) <= _doubles(best)) & (first != c))
            found = squared(vectors[rows], centroids[c])
            better = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
            better = better.astype(bool)
            cluster[rows[better]], best[rows[better]] = c, found[better]
            computed += len(rows)
        return cluster, best, computed


def _matrix(lists: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.float64).reshape(-1, dimension)


def _digits(value: int) -> list[int]:
    """Signed digits of ``DIGIT_BITS`` bits, the lowest first."""
    sign, value, found = (-1 if value < 0 else 1), abs(value), []
    while value:
        found.append(sign * (value & (1 << DIGIT_BITS) - 1))
        value >>= DIGIT_BITS
    return found


def _cached(index: Index, dimension: int, scale: int):
    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = roots(whole_numbers(_matrix(batch.column(1), dimension), scale), index.pivots)
            offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            pivot = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pivot], names=["id", "vector", "pivots"])

    return distances


def _assigned(index: Index, centroids: np.ndarray, dimension: int, scale: int, batches):
    for batch in batches:
        vectors = whole_numbers(_matrix(batch.column(1), dimension), scale)
        to_pivots = np.asarray(batch.column(2).flatten(), np.float64).reshape(len(vectors), len(index.pivots))
        held = centroids if vectors.dtype == centroids.dtype else centroids.astype(object)
        vectors = vectors if vectors.dtype == held.dtype else vectors.astype(object)
        yield batch, vectors, *index.nearest(vectors, to_pivots, held)[:2]


def _sums(index: Index, centroids: np.ndarray, dimension: int, scale: int):
    """(cluster, component, digit, part) of each cluster's sums; component -1 is its number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * dimension for _ in centroids]
        count = [0] * len(centroids)
        for _, vectors, cluster, _ in _assigned(index, centroids, dimension, scale, batches):
            for c in np.unique(cluster).tolist():
                of = vectors[cluster == c]
                total[c] = [t + int(s) for t, s in zip(total[c], of.sum(axis=0), strict=True)]
                count[c] += len(of)
        rows = [
            (c, i, d, part)
            for c, n in enumerate(count) if n
            for i, value in enumerate([n, *total[c]], -1)
            for d, part in enumerate(_digits(value))
        ]
        if rows:
            columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "component", "digit", "part"])

    return add


def _final(index: Index, centroids: np.ndarray, dimension: int, scale: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, best in _assigned(index, centroids, dimension, scale, batches):
            distance = pa.array([min(int(d), LARGEST) for d in best], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), distance], names=["id", "cluster", "distance"])

    return assign


def _moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The floored means of the clusters; what has no vector stays where it is."""
    parts = sums.groupBy("cluster", "component", "digit").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("part"))
    total: dict[int, dict[int, int]] = {}
    for r in parts.collect():  # at most a few numbers for each component of each centroid
        of = total.setdefault(r.cluster, {})
        of[r.component] = of.get(r.component, 0) + (int(r.part) << DIGIT_BITS * r.digit)
    moved = centroids.astype(object)
    for c, of in total.items():
        moved[c] = [of.get(i, 0) // of[-1] for i in range(centroids.shape[1])]
    return _narrow(moved)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64) if all(abs(v) < SMALL for v in x.ravel()) else x


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
    dimension: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1, pivots: int = 5,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors with exactly ``dimension`` components, none null or non-finite, take part, each as its whole numbers
    ``floor(scale * x)``.  Centroids start as the ``k`` vectors with the smallest sha256 of ``seed:id``, in that order;
    ``rounds`` times all vectors go to the nearest centroid and centroids to their vectors' floored mean.  All
    arithmetic that decides is exact; a squared distance or sum of them beyond 64 bits is given as the largest long.

    With fewer than ``k`` vectors there are that many centroids.  Rows with equal ids are taken as rows of their own,
    ordered by their components where they are to start a centroid; null ids start one only when no other is left.  Empty
    centroids stay.  An empty table gives no rows; other columns are ignored.
    """
    x = column(vector_col).cast("array<double>")
    kept = vectors.select(column(id_col).alias("id"), x.alias("vector")).filter(
        (F.size("vector") == dimension) & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "vector").limit(max(k, PIVOT_SAMPLE)).collect()
    spark, name = vectors.sparkSession, vectors.select(column(id_col)).columns[0]
    id_type = kept.schema["id"].dataType.simpleString()
    if not first:
        return kept.selectExpr(
            "id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256"
        ).withColumnRenamed("id", name)
    sample = whole_numbers(np.array([r.vector for r in first], np.float64), scale)
    index, centroids = Index.of(sample, pivots), _narrow(sample[:k])
    cached = written(
        kept.mapInArrow(_cached(index, dimension, scale), f"id {id_type}, vector array<double>, pivots array<double>"), "pivot_distances"
    )
    for _ in range(rounds):
        sums = cached.mapInArrow(_sums(index, centroids, dimension, scale), "cluster long, component long, digit long, part long")
        centroids = _moved(centroids, sums)
    assigned = written(
        cached.mapInArrow(_final(index, centroids, dimension, scale), f"id {id_type}, cluster int, distance long"), "clusters"
    )
    inertia = {r.cluster: int(r.inertia) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia")).collect()}
    names = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame(
        [(c, min(i, LARGEST), min(sum(inertia.values()), LARGEST), names[c]) for c, i in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(name), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
