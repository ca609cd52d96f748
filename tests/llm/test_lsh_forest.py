import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from fennec.llm import lsh_forest as J
from fennec.llm.graph import connected_components
from fennec.llm.queries import QUERIES


def shingle_set(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(id, text) with unique ids: id -> (class, links, copies)."""
    sets = defaultdict(list)
    for ident, text in rows:
        sets[shingle_set(text) or ident].append(ident)
    keys = list(sets)
    where, links, parent = defaultdict(list), Counter(), list(range(len(keys)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for n, s in enumerate(keys):
        common = Counter()
        for g in s if isinstance(s, frozenset) else ():
            common.update(where[g])
            where[g].append(n)
        for m, c in common.items():
            if c >= 0.8 * (len(s) + len(keys[m]) - c) - 1e-9:
                links[m] += 1
                links[n] += 1
                parent[find(n)] = find(m)
    members = defaultdict(list)
    for n, s in enumerate(keys):
        members[find(n)] += sets[s]
    return {i: (min(members[find(n)]), links[n], len(sets[s])) for n, s in enumerate(keys) for i in sets[s]}


def run(df, **kw):
    return {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in J.classes(df, **kw).collect()}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in QUERIES["op7_lsh_forest"](spark, sf).collect()}
    assert got == brute(list(zip(docs.doc_id, docs.text)))


def test_large_groups_in_small_blocks(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    rows = []
    for base in range(3):
        words = rng.choices(vocab, k=120)
        for _ in range(60):
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, " ".join(rng.choices(vocab, k=100))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    want = brute(rows)
    assert max(v[1] for v in want.values()) > 10
    assert run(df, block_nodes=16) == want
    assert run(df) == want


def test_prefix_is_shortened_until_the_recall_is_reached():
    n = J.prefix_length(0.8, 0.9999, 28, 8)
    reached = lambda k: 1 - (1 - 0.8 ** k) ** 28
    assert reached(n) >= 0.9999 and (n == 8 or reached(n + 1) < 0.9999)
    rng = np.random.default_rng(0)
    found = 0
    for _ in range(300):  # pairs at the threshold meet in some tree
        common = rng.integers(0, 2**63, 80, np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 10, np.uint64)])) for _ in range(2))
        s = J.signatures([a, b], 28, n)
        found += bool((s[0] == s[1]).any())
    assert found >= 298


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}


def test_odd_rows_and_keep_one(spark, odd_docs, no_docs):
    got = J.classes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.class_id, r.n_links, r.n_copies))
    assert by[4] == by[5] == {(4, 0, 3)} and by[1] == {(1, 0, 1)} and by[6] == {(6, 0, 1)}
    kept = J.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == {**{i: 1 for i in (1, 2, 3, 4, 6, 7, 8, 9, 10)}, None: 2}
    assert J.classes(no_docs).count() == 0 and J.keep_one(no_docs).count() == 0
