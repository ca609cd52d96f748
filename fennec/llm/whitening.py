"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The covariance is never formed.  A pass over the written vectors computes
V Q = Xc' (Xc Q) / n for a block Q of a few more columns than components wanted,
Xc being the centred vectors; tasks give back partial products (one row per
dimension), which Spark adds up.  Iteration: a Chebyshev polynomial of V, built
by its three-term recurrence with one pass per degree, is small on the unwanted
part of the spectrum (from 0 to the least Ritz value of the block) and grows fast
above it; QR makes the filtered block orthonormal; Rayleigh-Ritz (the eigenvectors
of Q' V Q, as small as the block) gives Ritz pairs.  It ends when the residuals
|V q - e q| of the wanted pairs certify them.

Centring is exact: sums of integers give the mean, whose integer part is
subtracted as an integer and whose fraction as a double.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import integer_vectors, matrix

COMPONENTS = 8
SHIFT = 100_000
#: Larger components are not exact as integers of 1024ths in doubles.
LIMIT = float(1 << 42)
#: Columns of the block beyond twice the components wanted (all dimensions, if they are fewer).
EXTRA = 16
DEGREE = 16
#: A wanted pair is certified when its residual is below this share of the largest eigenvalue.
TOLERANCE = 1e-13
#: Eigenvalues below this share of the largest one count as zero.
RANK_TOLERANCE = 1e-12
MAX_ROUNDS = 60


@dataclass
class Whitening:
    """``n`` vectors with the exact ``sums``; ``values`` (falling) and ``vectors`` (columns)
    of the wanted eigenpairs, their ``residuals``, the ``trace`` and the passes made."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    passes: int


def chebyshev_filter(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of the operator that stays small on
    [``low``, ``high``] and is about 1 at ``top``, applied to ``q``."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, y = q, (apply(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, y = y, (apply(y) - middle * y) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return y


def _centre(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean as integers and a fraction."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def _add_up(parts: DataFrame, width: int) -> np.ndarray:
    """Partial matrices (rows ``i``, ``v``) added up: ``i`` in order, ``width`` columns."""
    rows = parts.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width)]).collect()
    return np.array([r[1:] for r in sorted(rows)])


def _product(points: DataFrame, dims: int, whole: np.ndarray, part: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    """One pass: V ``q``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(q.shape)
        for batch in batches:
            z = (matrix(batch.column("__x"), dims) - whole) - part
            total += z.T @ (z @ q)
        yield _rows(total)

    return _add_up(points.select("__x").mapInArrow(run, "i int, v array<double>"), q.shape[1]) / n


def _rows(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "v"])


def fit(points: DataFrame, dims: int, components: int = COMPONENTS, degree: int = DEGREE, extra: int = EXTRA,
        tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> Whitening:
    """Eigenpairs of the covariance of the written integer vectors ``__x``."""
    total = points.agg(F.count("*").alias("n"), *[F.sum(F.col("__x")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]).first()
    n, sums = total["n"], [int(total[f"s{i}"]) for i in range(dims)]
    whole, part = _centre(sums, n)
    block, passes = min(dims, 2 * components + extra), 0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return _product(points, dims, whole, part, n, q)

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sum_of = 0.0
        for batch in batches:
            z = (matrix(batch.column("__x"), dims) - whole) - part
            sum_of += float(np.einsum("ij,ij->", z, z))
        yield _rows(np.array([[sum_of]]))

    trace = float(_add_up(points.select("__x").mapInArrow(square, "i int, v array<double>"), 1)[0, 0]) / n
    want = min(components, dims)
    q = np.linalg.qr(np.random.default_rng(13).standard_normal((dims, block)))[0]
    best = np.inf
    for round_ in range(max_rounds):
        product = apply(q)
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        residuals = np.linalg.norm(product - q * values, axis=0)[:want]
        worst = residuals.max() / max(values[0], np.finfo(float).tiny)
        # the block spans everything, or the pairs are certified, or rounding stops them from getting better
        if values[0] <= 0 or block == dims or worst <= tolerance or (worst <= 100 * tolerance and worst > best / 2):
            break
        best = min(best, worst)
        # a flat spectrum leaves nothing to damp: plain subspace iteration then
        high = max(values[-1], 0.0)
        spread = high > 1e-14 * values[0] and values[0] > high * (1 + 1e-9)
        y = chebyshev_filter(apply, q, degree, 0.0, high, values[0]) if spread else product
        q = np.linalg.qr(y)[0]
    else:
        raise ArithmeticError(f"residual {worst:.1e} after {max_rounds} rounds, not {tolerance:.1e}")
    keep = values[:want] > RANK_TOLERANCE * max(values[0], 0.0)
    return Whitening(n, sums, values[:want][keep], q[:, :want][:, keep], residuals[keep], trace, passes)


def dimensions(points: DataFrame) -> int:
    """The commonest number of components (the largest of equally common ones; 0 without rows)."""
    rows = points.groupBy(F.size("__x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows[0]["d"] if rows else 0


OUT = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           dims: int | None = None, **kw) -> DataFrame:
    """One row per vector and component: ``id_col``, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation`` (exact sum over dimensions of (n x - S)**2),
    ``whitened``, ``explained``, ``identity_error``.

    Left out are null and empty vectors, those with a null, NaN or infinite
    component or one beyond ``LIMIT`` in absolute value, and those whose number of
    components is not ``dims`` (None: the commonest one).  Components whose
    eigenvalue is zero (see ``RANK_TOLERANCE``) have no whitened value and no rows:
    one vector, or many equal ones, give none.  Repeated rows are vectors of their
    own, ids may be null, other columns are ignored.
    """
    spark = df.sparkSession
    points = written(integer_vectors(df, id_col, vector_col, LIMIT, dims, SHIFT), "whitening-points")
    kind = points.schema["__id"].dataType.simpleString()
    dims = dims or dimensions(points)
    points = points.where(F.size("__x") == dims)
    model = fit(points, dims, components, **kw) if dims and not points.isEmpty() else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], f"__id {kind}, {OUT}").withColumnRenamed("__id", id_col)
    n, sums, k = model.n, model.sums, len(model.values)
    whole, part = _centre(sums, n)
    # n x - S = n (x - whole) - rest, and its square over all dimensions, from integers that fit a long
    rest = [s - int(w) * n for s, w in zip(sums, whole)]
    turn = model.vectors / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("__x"), dims) - whole
            y = (x - part) @ turn
            large = float(np.abs(x).max(initial=0) + 1) * n
            if large * large * dims < 2.0 ** 62:
                d = n * x - np.array(rest, np.int64)
                deviation = [int(v) for v in np.einsum("ij,ij->i", d, d)]
            else:  # exact beyond a long, too
                deviation = [sum((n * v - r) ** 2 for v, r in zip(row, rest)) for row in x.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array(map(str, deviation), pa.string()), pa.array(y.tolist(), pa.list_(pa.float64()))],
                names=["__id", "deviation", "y"])

    scores = written(points.mapInArrow(project, f"__id {kind}, deviation string, y array<double>"), "whitening-scores")
    # covariance of what was written; whitened values have mean 0 but for rounding, which the covariance takes off
    y = [F.col("y")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = scores.agg(*[F.covar_pop(y[i], y[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values])
    return scores.select("__id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        F.col("__id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", explained[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"))
