import itertools
import zlib

import numpy as np
import pandas as pd

from fennec.llm import crf_language as C
from fennec.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    k, lengths = 3, np.array([4, 1, 3])
    scores, trans, start = rng.normal(size=(8, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = np.array([0, 4, 5])
    prob, pairs, heads = C.marginals(scores, first, lengths, trans, start, pairs=True)
    want, want_pairs = np.zeros((8, k)), np.zeros((k, k))
    for f, n in zip(first, lengths):
        total = {y: np.exp(start[y[0]] + sum(scores[f + t, y[t]] for t in range(n)) + sum(trans[y[t], y[t + 1]] for t in range(n - 1)))
                 for y in itertools.product(range(k), repeat=int(n))}
        z = sum(total.values())
        for y, v in total.items():
            for t in range(n):
                want[f + t, y[t]] += v / z
            for t in range(n - 1):
                want_pairs[y[t], y[t + 1]] += v / z
    assert np.allclose(prob, want) and np.allclose(pairs, want_pairs) and np.allclose(heads, want[first].sum(axis=0))


def test_words_and_their_hashes():
    texts = ["Ab, cd", "", "é1x", None or "", "Ab"]
    points, s, e, owner = C.tokenize(texts)
    assert ["".join(map(chr, points[a:b])) for a, b in zip(s, e)] == ["ab", "cd", "é", "x", "ab"]
    assert owner.tolist() == [0, 0, 2, 2, 4]
    h = C.word_hashes(points, s, e)
    assert h[0] == h[4] and len(set(h.tolist())) == 4


def test_held_out_accuracy_and_code_switching():
    d = pd.read_parquet(f"{SF}/documents.parquet")
    held = d.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    learn = d[~held & d.lang.notna()].groupby("lang").head(120)
    model = C.fit([(t[:900], y) for t, y in zip(learn.text, learn.lang)])
    test = d[held & d.lang.notna()].head(600)
    got, score = C.predict(model, list(test.text))
    assert np.mean(np.array(got) == test.lang) > 0.98
    assert min(score) >= 0 and max(score) <= 1
    # half one language, half another: every word gets its own half's label
    one = " ".join(test[test.lang == "de"].text.iloc[0].split()[:60])
    two = " ".join(test[test.lang == "es"].text.iloc[0].split()[:60])
    p, s, e, owner = C.tokenize([one + " " + two])
    prob = C.marginals(C.emissions(model, p, s, e), np.array([0]), np.array([len(s)]), model.transitions, model.start)
    said = np.array(model.labels)[prob.argmax(axis=1)]
    n = len(C.tokenize([one])[1])
    assert np.mean(said[:n] == "de") > 0.9 and np.mean(said[n:] == "es") > 0.9
    assert np.all(np.diag(model.transitions) > model.transitions.mean(axis=1))


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_crf_language"](spark, sf).toPandas().set_index("doc_id").sort_index()
    docs = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id").sort_index()
    assert got.index.tolist() == docs.index.tolist()
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index]
    both = got.held_out & docs.lang.notna()
    assert (got.lang_pred == docs.lang)[both].mean() > 0.97


def test_labels_of_held_out_rows_are_never_learned(spark):
    rows = [(i, "palabra otra cosa" if i % 2 else "some word thing", "es" if i % 2 else "en") for i in range(200)]
    rows = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, t, y in rows]
    model = C.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.labels == ("en", "es")


def test_odd_rows(spark, odd_docs, no_docs):
    model = C.fit([("the word and other words of it", "en"), ("la palabra y otras", "es")] * 5)
    got = C.identify(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    texts = [r.text for r in odd_docs.collect()]
    for t, r in zip(texts, got):
        if t is None or not any(c.isalpha() for c in t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "es") and 0 < r.score <= 1
    assert C.train(no_docs) is None
    assert {r.lang_pred for r in C.identify(odd_docs, None).collect()} == {"und"}
    assert C.identify(no_docs, model).count() == 0


def test_marks_alone_are_no_words():
    points, starts, ends, owner = C.tokenize(["\u0301\u0308", "a\u0301b \u0300 c", ""])
    words = ["".join(map(chr, points[a:b])) for a, b in zip(starts, ends)]
    assert words == ["a\u0301b", "c"] and owner.tolist() == [1, 1]
