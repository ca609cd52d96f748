import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from fennec.llm import minhash_stars as M
from fennec.llm.queries import QUERIES


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[j:j + 4]) for j in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    """(id, text) with unique ids: id -> (set size, least id reachable)."""
    sets = defaultdict(list)
    for ident, text in rows:
        sets[shingle_set(text) or ident].append(ident)
    keys, where, parent = list(sets), defaultdict(list), list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a

    for n, s in enumerate(keys):
        common = Counter()
        for g in s if isinstance(s, frozenset) else ():
            common.update(where[g])
            where[g].append(n)
        for m, c in common.items():
            if 100 * c >= 80 * (len(s) + len(keys[m]) - c):
                parent[find(n)] = find(m)
    least = {}
    for n, s in enumerate(keys):
        least[find(n)] = min([least.get(find(n), sets[s][0]), *sets[s]])
    return {i: (len(s) if isinstance(s, frozenset) else 0, least[find(n)]) for n, s in enumerate(keys) for i in sets[s]}


def run(df, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in M.components(df, **kw).collect()}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op12_minhash_stars"](spark, sf).collect()
    want = brute(list(zip(docs.doc_id, docs.text)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len({c for _, c in want.values()}) < len(want)


def test_densified_bins_agree_as_often_as_sets_do():
    rng = np.random.default_rng(3)
    for size, bins in ((6, 180), (40, 180), (2000, 180)):
        agree, truth = [], []
        for _ in range(150):
            common = rng.integers(0, 1 << 63, size, np.uint64)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, max(1, size // 8), np.uint64)])) for _ in range(2))
            sig = M.signatures([a, b], bins)
            agree.append((sig[0] == sig[1]).mean())
            truth.append(size / (2 * max(1, size // 8) + size))
        assert abs(np.mean(agree) - np.mean(truth)) < 0.03
    alone = M.signatures([a], bins)
    assert (alone[0] == sig[0]).all()  # what else is in a batch does not matter


@pytest.fixture(scope="module")
def family():
    """Texts of which neighbours are similar but most are not, so that no hub is linked with all."""
    rng = random.Random(7)
    words = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(words)
        words[rng.randrange(60)] = f"n{i}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(f"o{i // 2}w{j}" for j in range(30 + i % 2))) for i in range(60)]
    rows += [(3000 + i, rows[3][1]) for i in range(200)]
    return rows


@pytest.mark.parametrize("kw", [dict(), dict(star_rounds=0, block_nodes=7), dict(star_rounds=1, hub_edges=3, block_nodes=50), dict(star_rounds=4)])
def test_no_link_is_lost(spark, family, kw):
    got = run(spark.createDataFrame(family, "doc_id int, text string"), **kw)
    assert got == brute(family)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = M.components(odd_docs).collect()
    assert len(rows) == odd_docs.count() and set(rows[0].asDict()) == {"doc_id", "n_shingles", "component_id", "kept"}
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [(r.n_shingles, r.component_id, r.kept) for r in by[1] + by[2] + by[3]] == [(0, i, True) for i in (1, 2, 3)]
    assert by[4][0].component_id == by[4][1].component_id == by[5][0].component_id == 4 and not by[5][0].kept
    assert by[8][0].n_shingles == by[9][0].n_shingles == 1 and by[6][0].kept
    assert {r.component_id for r in by[None]} == {None} and all(r.kept for r in by[None])
    assert M.components(no_docs).count() == 0
    null_first = M.components(odd_docs.sparkSession.createDataFrame(
        [(None, "a b c d"), (5, "a b c d"), (6, "A  B c\td")], "doc_id int, text string")).collect()
    assert {r.component_id for r in null_first} == {None} and sum(r.kept for r in null_first) == 1
