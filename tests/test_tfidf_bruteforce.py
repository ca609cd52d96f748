"""TF-IDF against a brute-force Python computation of the same definition
(Python's own Unicode word tokens, NFKD accent stripping, stop words removed
before n-grams, inclusive df bounds, top-k by total count then term, smooth
idf, optional sublinear tf, L2 rows) on the smallest documents table."""

import math
import re
import unicodedata
from collections import Counter

import pytest

from fennec.functions.text import english_stop_words
from fennec.operators.tfidf import TfidfVectorizer
from fennec.sources.tables import table

SF = "/root/testdata/sf0.001"


def analyse(text, strip, stop, lo, hi):
    t = (text or "").lower()
    if strip:
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    toks = [w for w in re.findall(r"(?u)\b\w\w+\b", t) if w not in stop]
    out = []
    for n in range(lo, hi + 1):
        out += [" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1)]
    return out


def brute(docs, k, ngram, min_df, max_df, strip, sublinear):
    stop = set(english_stop_words())
    tfs = {i: Counter(analyse(t, strip, stop, *ngram)) for i, t in docs}
    n = len(docs)
    df, total = Counter(), Counter()
    for c in tfs.values():
        for term, cnt in c.items():
            df[term] += 1
            total[term] += cnt
    hi = max_df if isinstance(max_df, int) else max_df * n
    lo = min_df if isinstance(min_df, int) else min_df * n
    kept = [t for t in df if lo <= df[t] <= hi]
    kept = sorted(kept, key=lambda t: (-total[t], t))[:k]
    vocab = sorted(kept)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    weights = {}
    for i, c in tfs.items():
        w = {t: ((1 + math.log(c[t])) if sublinear else c[t]) * idf[t] for t in vocab if c[t]}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            weights[(i, vocab.index(t))] = x / norm
    return vocab, idf, weights


@pytest.mark.parametrize("params", [
    dict(max_features=150, ngram_range=(1, 3), min_df=3, max_df=0.85, strip_accents=True, sublinear_tf=True),
    dict(max_features=100, ngram_range=(1, 2), min_df=5, max_df=1.0, strip_accents=False, sublinear_tf=False),
])
def test_tfidf_matches_brute_force(spark, params):
    docs_df = table(spark, SF, "documents")
    docs = [(r.doc_id, r.text) for r in docs_df.select("doc_id", "text").collect()]
    vocab, idf, weights = brute(docs, params["max_features"], params["ngram_range"], params["min_df"], params["max_df"],
                                params["strip_accents"], params["sublinear_tf"])
    m = TfidfVectorizer(**params).fit(docs_df, "doc_id", "text")
    got_vocab = {r.term: (r.idx, r.idf) for r in m.vocab.collect()}
    assert sorted(got_vocab) == vocab
    for t, (i, v) in got_vocab.items():
        assert vocab[i] == t and math.isclose(v, idf[t], rel_tol=1e-12)
    got = {(r.doc_id, r.idx): r.weight for r in m.transform_long(docs_df, "doc_id", "text").collect()}
    assert set(got) == set(weights)
    for key, w in weights.items():
        assert math.isclose(got[key], w, rel_tol=1e-9, abs_tol=1e-12)
