import numpy as np
import pandas as pd

from fennec.llm import whitening as W
from fennec.llm.queries import QUERIES


def reference(x, k):
    """Eigenpairs and exact deviations by a full eigendecomposition."""
    n, mean = len(x), x.mean(axis=0)
    cov = (x - mean).T @ (x - mean) / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    sums = [int(v) for v in x.astype(object).sum(axis=0)]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return (x - mean) @ vectors / np.sqrt(values), values / np.trace(cov), deviation


def test_query_against_eigendecomposition(spark):
    sf = "/root/testdata/sf0.1"
    e = pd.read_parquet(f"{sf}/embeddings.parquet")
    x = np.floor(1024 * np.stack(e.embedding).astype(float)) + 100_000
    white, explained, deviation = reference(x, 8)
    got = QUERIES["op13_whitening"](spark, sf).toPandas()
    assert len(got) == 8 * len(e) and (got.n == len(e)).all()
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[e.vec_id].to_numpy()
    assert np.abs(table * np.sign((table * white).sum(axis=0)) - white).max() < 1e-9
    assert np.abs(got.drop_duplicates("component").set_index("component").explained.sort_index().to_numpy() / explained - 1).max() < 1e-10
    assert got[got.component == 1].set_index("vec_id").deviation.loc[e.vec_id].tolist() == deviation
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error[0] < 1e-10


def test_filter_damps_the_unwanted_interval():
    values = np.linspace(0, 1, 40) ** 3
    apply = lambda q: values[:, None] * q
    y = W.chebyshev_filter(apply, np.ones((40, 1)), 12, 0.0, values[30], values[-1])[:, 0]
    assert abs(y[-1] - 1) < 1e-9 and np.abs(y[:31]).max() < 1e-3 and (np.diff(y[31:]) > 0).all()


def test_close_and_zero_eigenvalues(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((400, 40)) * np.array([3, 2.999, 2.998, 1, 1, 1, 1, 1, 1, 1, 1] + [0.9] * 29)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(base)], "vec_id int, embedding array<double>")
    x = np.floor(1024 * base) + 100_000
    white, explained, deviation = reference(x, 3)
    got = W.whiten(df, components=3).toPandas()
    table = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    assert np.abs(table * np.sign((table * white).sum(axis=0)) - white).max() < 1e-7
    # two directions only: no rows for components of eigenvalue zero
    flat = spark.createDataFrame([(i, [float(i), float(i * i % 7), 5.0]) for i in range(30)], "vec_id int, embedding array<double>")
    got = W.whiten(flat).toPandas()
    assert sorted(got.component.unique()) == [1, 2] and len(got) == 60 and got.identity_error[0] < 1e-9


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, -1.0]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [1.0, float("inf")]), (8, [1e300, 1.0]), (9, [1.0]), (10, [-7.25, 3.5])]
    df = spark.createDataFrame([(*r, 5, "c") for r in rows], "vec_id int, embedding array<double>, n int, __id string")
    got = W.whiten(df).toPandas()
    kept = np.floor(1024 * np.array([[1, 2], [1, 2], [2, -1], [-7.25, 3.5]])) + 100_000
    assert len(got) == 8 and set(got.n) == {4}
    assert sorted(map(int, got[got.component == 1].deviation)) == sorted(reference(kept, 2)[2])
    assert W.whiten(df.limit(0)).count() == 0
    assert W.whiten(df.where("vec_id = 1")).count() == 0  # equal vectors have no spread
    large = spark.createDataFrame([(i, [float(4_000_000_000 * (i % 2)), float(i)]) for i in range(6)], "vec_id int, embedding array<double>")
    got = W.whiten(large)
    x = np.floor(1024 * np.array([[4e9 * (i % 2), i] for i in range(6)])) + 100_000
    assert sorted(int(r.deviation) for r in got.where("component = 1").collect()) == sorted(reference(x, 2)[2])
