import hashlib

import numpy as np
import pandas as pd
import pytest

from fennec.llm import pivot_kmeans as P
from fennec.llm.queries import QUERIES


def brute(rows, k=P.K, rounds=P.ROUNDS, seed=P.SEED):
    """(id, integer vector) rows: id -> (cluster, distance), centroids."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), list(r[1])))
    cents = [[int(v) for v in x] for _, x in order[:k]]
    xs = [[int(v) for v in x] for _, x in rows]

    def assign():
        out = []
        for x in xs:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(cents)):
            own = [x for x, f in zip(xs, found) if f[0] == c]
            if own:
                cents[c] = [sum(v) // len(own) for v in zip(*own)]
    return assign(), cents


def integers(v):
    return np.floor(1024 * np.asarray(v, float)).astype(int)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    e = pd.read_parquet(f"{sf}/embeddings.parquet")
    want, cents = brute([(i, integers(v)) for i, v in zip(e.vec_id, e.embedding)])
    got = {r.vec_id: r for r in QUERIES["op11_pivot_kmeans"](spark, sf).collect()}
    assert len(got) == len(e)
    per = {}
    for c, d in want:
        per[c] = per.get(c, 0) + d
    for i, (c, d) in zip(e.vec_id, want):
        r = got[i]
        assert (r.cluster, r.distance, r.cluster_inertia, r.inertia) == (c, d, per[c], sum(per.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()


def test_bounds_are_bounds_and_prune():
    rng = np.random.default_rng(4)
    centres = rng.integers(-5000, 5000, (8, 16))
    x = (centres[rng.integers(0, 8, 4000)] + rng.integers(-60, 60, (4000, 16))).astype(np.int64)
    pivots = x[:8].copy()
    cents = centres.astype(np.int64)
    pairs = P.pivot_pairs(pivots)
    to, between = P._pivot_distances(x, pivots), P._pivot_distances(cents, pivots)
    full = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (P.lower_bounds(to, between, pairs) <= full).all()
    cluster, distance, compared = P.nearest(x, to, cents, between, pairs)
    assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert compared.mean() < 6 and compared.min() >= 1


@pytest.mark.parametrize("scale", [1, 1 << 26])
def test_ties_and_exactness(scale):
    # every vector is as far from both centroids; the smaller number wins
    x = np.array([[0, i] for i in range(50)], np.int64) * scale // 64
    cents = np.array([[9, 0], [-9, 0], [9, 0]], np.int64) * scale // 64
    pivots = np.array([[0, 0], [5, 7], [0, 0]], np.int64) * scale // 64
    cluster, distance, _ = P.nearest(x, P._pivot_distances(x, pivots), cents, P._pivot_distances(cents, pivots), P.pivot_pairs(pivots))
    assert (cluster == 0).all() and (distance == ((x - cents[0]) ** 2).sum(axis=1)).all()


def test_odd_rows(spark):
    ok = [0.25, -1.5]
    rows = [(1, ok), (1, ok), (None, [0.1, 0.2]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [1.0, float("nan")]),
            (8, [float("-inf"), 0.0]), (9, [1e30, 0.0]), (10, [3.0, 4.0]), (11, [3.0, 4.0])]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id int, embedding array<float>, cluster int, __x string")
    out, cents = P.kmeans(df, dims=2, k=3)
    kept = [(1, ok), (1, ok), (None, [0.1, 0.2]), (10, [3.0, 4.0]), (11, [3.0, 4.0])]
    want, want_cents = brute([("" if i is None else i, integers(np.float32(v))) for i, v in kept], k=3)
    assert cents == want_cents
    got = sorted((r.vec_id or 0, r.cluster, r.distance) for r in out.collect())
    assert got == sorted((i or 0, c, d) for (i, _), (c, d) in zip(kept, want))
    out, cents = P.kmeans(df.limit(0), dims=2)
    assert out.count() == 0 and cents == [] and out.columns[0] == "vec_id"
    out, cents = P.kmeans(df.where("vec_id = 10"), dims=2)
    assert len(cents) == 1 and out.first().distance == 0
