import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fennec.llm import nbest as N
from fennec.llm.queries import QUERIES


@pytest.fixture(scope="module")
def seg():
    return N.segmenter(public_tokenizers.path("piece_bpe_32k.model"))


def every_path(seg, marked):
    paths = {0: [(0.0, ())]}
    for j, arcs in enumerate(seg.lattice(marked)[1:], 1):
        paths[j] = [(a + score, done + ids) for i, score, ids in arcs for a, done in paths[i]]
    return sorted(paths[len(marked)], key=lambda p: -p[0])


@settings(max_examples=120, deadline=None)
@given(text=st.text(st.sampled_from("the in.a,é 日\n\t▁x1"), max_size=9), n=st.integers(1, 6))
def test_n_best_against_all_paths(text, n):
    seg = N.segmenter(public_tokenizers.path("piece_bpe_32k.model"))
    paths = every_path(seg, seg.marked(text))
    got = seg.encode(text, n)
    assert np.allclose([g[0] for g in got], [p[0] for p in paths[:n]])
    ids = [tuple(np.frombuffer(b, seg.kind).tolist()) for _, b in got]
    assert len(set(ids)) == len(ids) and set(ids) <= {p[1] for p in paths}
    assert all(seg.decode(i) == text for i in ids)
    if text:  # A-star over the whole lattice, uncut
        assert np.allclose([s for s, _ in seg.nbest(seg.marked(text), n)], [p[0] for p in paths[:n]])


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_round_trip_of_any_text(text):
    seg = N.segmenter(public_tokenizers.path("piece_bpe_32k.model"))
    text = text.encode("utf-8", "ignore").decode()
    assert all(seg.decode(np.frombuffer(b, seg.kind).tolist()) == text for _, b in seg.encode(text, 3))


def test_many_at_once_equals_one_by_one(seg):
    texts = list(pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text.fillna(""))[:40]
    for s in {x for t in texts for x in seg.segments([seg.marked(t)])[0]}:
        ids, score, regret = seg.best([s])[0]
        top = seg.nbest(s, 2)
        assert np.isclose(score, top[0][0])
        assert np.isclose(regret, top[0][0] - top[1][0]) if len(top) > 1 else np.isinf(regret)
        assert np.isclose(sum(seg.scores[i] for i in np.frombuffer(ids, seg.kind)), score) or seg.unknown > score - 1e9
    both = list(seg.encode_all(texts, 3))
    assert both == [seg.encode(t, 3) for t in texts]


def test_query_and_odd_rows(spark, odd_docs, no_docs, seg):
    got = QUERIES["op4_nbest"](spark, "/root/testdata/sf0.001").toPandas().set_index("doc_id")
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet").set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index) and got.round_trip.all()
    for i in list(docs.index)[:15]:
        want = seg.encode(docs.text[i], N.N_BEST)
        assert got.ids_crc32[i].tolist() == [zlib.crc32(np.frombuffer(b, seg.kind).astype("<u4").tobytes()) for _, b in want]
    odd = N.digests(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(r.round_trip for r in odd)
    assert N.digests(no_docs).count() == 0
    rows = N.encode(odd_docs, 2, keep=["node", "score"])
    back = N.decode(rows.select("doc_id", "rank", "ids"), ["doc_id", "rank"])
    want = sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.text) for r in back.where("rank = 0").collect()) == want
    assert N.decode(rows.select(F.lit(None).cast("array<int>").alias("ids"), "doc_id"), ["doc_id"]).first().text is None
