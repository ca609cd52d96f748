import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fennec.llm.queries import QUERIES
from fennec.llm.token_store import EliasFano, read_store, write_store

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(rows):
    at, out = 0, []
    for ident, text in rows:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((ident, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano_select(steps):
    values = np.cumsum(steps) if steps else np.zeros(0, np.int64)
    ef = EliasFano.encode(values, int(values[-1]) if steps else 0)
    assert ef.values().tolist() == values.tolist()
    assert [ef.select(i) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_near_minimal():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    ef = EliasFano.encode(values, int(values[-1]))
    bits = 8 * (len(ef.low) + len(ef.high) + len(ef.hints)) / len(values)
    assert bits < 2.3 + np.log2(values[-1] / len(values))
    with pytest.raises(IndexError):
        ef.select(len(values))


def test_store_equals_whole_text_encoding(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["op1_token_store"](spark, sf).collect()))
    docs = pd.read_parquet(f"{sf}/documents.parquet").sort_values("doc_id")
    assert got == expected(zip(docs.doc_id, docs.text))


def test_odd_rows_and_blocks(spark, odd_docs, no_docs, tmp_path):
    write_store(odd_docs, str(tmp_path / "a"), block_tokens=50)
    got = read_store(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    texts = odd_docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(i), n, c) for t in texts for i, _, n, c in expected([tuple(t)]))
    write_store(no_docs, str(tmp_path / "b"))
    assert read_store(spark, str(tmp_path / "b")).count() == 0
