"""Centroid clustering of integer vectors with Ptolemaic pivots.

Lloyd's rounds on exact integers.  Euclidean distances fulfil Ptolemy's
inequality, so for every pair of pivots (p, s) and every centroid c

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s).

The pivots are the first centroids and stay fixed; a vector's distances to them
are computed once and written beside it.  In each round only the few centroids
have to be compared with the pivots; a vector is compared exactly with the
centroid of least bound, then with those centroids whose bound does not exceed
the best distance found.  Bounds are lowered by more than the rounding errors of
their terms, and all comparisons that decide are between integers, so the result
is that of the full comparison, ties included.

Each round is one pass over the written vectors: tasks give back sums and counts
per centroid (at most ``k`` rows), Spark adds them up and the driver holds the
centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import SCALE, arrays, hex_sha256, integer_vectors, matrix

K, ROUNDS, DIMS, SEED = 8, 10, 64, 3
#: Relative error allowed for in a bound; its terms have a few units of 2**-53 each.
SLACK = 2.0 ** -46


def limit(dims: int) -> float:
    """The largest absolute component (131,072 for 64 dimensions): beyond it a squared
    distance need not fit a long."""
    return 2.0 ** 30 / dims ** 0.5 / SCALE


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one vector or, row by row, to those of ``c``."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def pivot_pairs(pivots: np.ndarray) -> list[tuple[int, int, float]]:
    """All pairs of different pivots, with their distance."""
    out = []
    for i in range(len(pivots)):
        for j in range(i + 1, len(pivots)):
            d = int(squared_distances(pivots[i][None], pivots[j])[0])
            if d:
                out.append((i, j, float(np.sqrt(float(d)))))
    return out


def lower_bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """A bound below the squared distance of every row to every centroid: Ptolemy's
    inequality over the pairs of pivots, rounded down."""
    best = np.zeros((len(to_pivots), len(centroid_to_pivots)))
    for p, s, apart in pairs:
        left = to_pivots[:, p, None] * centroid_to_pivots[None, :, s]
        right = to_pivots[:, s, None] * centroid_to_pivots[None, :, p]
        bound = (np.abs(left - right) - SLACK * (left + right)) / apart
        np.maximum(best, bound, out=best)
    return best * best * (1 - SLACK)


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_to_pivots: np.ndarray,
            pairs: list[tuple[int, int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each row (ties: the smaller number), its squared distance,
    and how many centroids the row was compared with exactly."""
    bounds = lower_bounds(to_pivots, centroid_to_pivots, pairs)
    cluster = bounds.argmin(axis=1)
    first = cluster.copy()
    distance = squared_distances(x, centroids[cluster])
    compared = np.ones(len(x), np.int64)
    for c in range(len(centroids)):
        # a double of the distance, rounded up
        at = np.flatnonzero((first != c) & (bounds[:, c] <= distance * (1 + SLACK)))
        d = squared_distances(x[at], centroids[c])
        compared[at] += 1
        closer = (d < distance[at]) | ((d == distance[at]) & (c < cluster[at]))
        distance[at[closer]], cluster[at[closer]] = d[closer], c
    return cluster, distance, compared


def _pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared_distances(x, p) for p in pivots], axis=1).astype(np.float64))


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of least sha256 of ``seed:id`` (fewer if there are fewer);
    of equal ids the least vector comes first."""
    order = hex_sha256(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))))
    rows = points.select(order.alias("o"), "__x").orderBy("o", "__x").limit(k).collect()
    return np.array([r["__x"] for r in rows], np.int64)


def kmeans(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
           dims: int = DIMS, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """One row per kept vector, and the final centroids.

    Rows: ``id_col``, ``cluster``, ``distance`` (squared), ``n_compared``
    (centroids compared exactly), ``cluster_inertia``, ``inertia``.

    Left out are null vectors, those without exactly ``dims`` components, with a
    null, NaN or infinite one, or with one beyond ``limit`` in absolute value.
    Vectors become floor(1024 x).  With fewer than ``k`` vectors there are as many
    centroids as vectors, with none an empty result.  Null ids order as empty
    text.  Repeated rows are vectors of their own; a centroid without vectors
    stays where it is.  Other columns are ignored.
    """
    spark = df.sparkSession
    points = integer_vectors(df, id_col, vector_col, limit(dims), dims)
    pivots = first_centroids(points, k, seed)
    kind = points.schema["__id"].dataType.simpleString()
    out_schema = f"__id {kind}, cluster int, distance bigint, n_compared int"
    if not len(pivots):
        empty = spark.createDataFrame([], out_schema + ", cluster_inertia bigint, inertia bigint")
        return empty.withColumnRenamed("__id", id_col), []
    pairs = pivot_pairs(pivots)

    def cache(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("__x"), dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), arrays(x), arrays(_pivot_distances(x, pivots))], names=["__id", "__x", "__p"])

    points = written(points.mapInArrow(cache, f"__id {kind}, __x array<bigint>, __p array<double>"), "kmeans-points")

    def assigned(batch: pa.RecordBatch, centroids: np.ndarray):
        x, p = matrix(batch.column("__x"), dims), matrix(batch.column("__p"), len(pivots))
        return x, *nearest(x, p, centroids, _pivot_distances(centroids, pivots), pairs)

    def sums_with(centroids: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(centroids), dims), np.int64), np.zeros(len(centroids), np.int64)
            for batch in batches:
                x, cluster, _, _ = assigned(batch, centroids)
                for c in range(len(centroids)):
                    own = cluster == c
                    total[c] += x[own].sum(axis=0)
                    count[c] += own.sum()
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at]), arrays(total[at])], names=["cluster", "n", "total"])

        return run

    def labels_with(centroids: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, cluster, distance, compared = assigned(batch, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__id"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(compared.astype(np.int32))],
                    names=["__id", "cluster", "distance", "n_compared"])

        return run

    centroids = pivots.copy()
    narrow = points.select("__x", "__p")
    for _ in range(rounds):
        parts = narrow.mapInArrow(sums_with(centroids), "cluster bigint, n bigint, total array<bigint>")
        counts = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dims)])
        for r in counts.collect():  # at most k rows
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    labelled = written(points.select("__id", "__x", "__p").mapInArrow(labels_with(centroids), out_schema), "kmeans-labels")
    wide = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("bigint").alias("cluster_inertia"))
    inertia = {r["cluster"]: r["cluster_inertia"] for r in wide.collect()}
    own = F.create_map(*[F.lit(v) for c, i in inertia.items() for v in (c, i)])
    out = labelled.withColumn("cluster_inertia", own[F.col("cluster")].cast("bigint")).withColumn(
        "inertia", F.lit(sum(inertia.values())).cast("bigint"))
    return out.withColumnRenamed("__id", id_col), centroids.tolist()


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
