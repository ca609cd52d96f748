import re

import corpus_pipeline as P
from fennec.llm.winnowing import contamination
from fennec.sources.tables import table

from .test_line_chunks import all_runs
from .test_lsh_forest import brute as brute_classes

SF = "/root/testdata/sf0.01"


def test_every_stage_against_brute_force(spark, tmp_path):
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "encoding":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        before, docs = {r.doc_id: r for r in docs.collect()}, spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and docs.count() == len(after)
        seen.append((name, before, after))
    (_, b, language), (_, _, lines), (_, _, near), (_, _, clean), (_, _, ids) = seen
    assert len(language) > 0.98 * len(b) and all(re.search(r"[^\W\d_]", r.text) for r in language.values())
    want = all_runs([(i, r.text) for i, r in language.items()])
    assert {i: r.text for i, r in lines.items()} == {i: t for i, (n, t) in want.items() if not n or t.strip()}
    assert all(r.n_chars == len(r.text) for r in lines.values())
    classes = brute_classes([(i, r.text) for i, r in lines.items()])
    assert set(near) == {i for i, c in classes.items() if c[0] == i} and len(near) < len(lines)
    found = contamination(table(spark, SF, "documents"), table(spark, SF, "benchmark"))
    hit = {r.doc_id for r in found.where("n_hit > 0").collect()}
    assert set(near) - set(clean) and set(near) - set(clean) <= hit
    assert set(ids) == set(clean) and all(len(r.ids) == r.n_pieces > 0 and r.round_trip for r in ids.values())
    assert all(r.scores == sorted(r.scores, reverse=True) and len(r.ids_crc32) == r.n_found for r in ids.values())
    assert max(r.n_found for r in ids.values()) > 1


def test_run_and_registration(spark):
    import __spark_entry__

    assert [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "encoding"]
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14))
    assert P.run(spark, "/root/testdata/sf0.001").count() > 100


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = stage(spark, docs, SF)
        if name != "encoding":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema) if out.count() else docs
        else:
            assert out.count() == docs.count()
    left = {r.doc_id for r in docs.collect()}
    assert 6 in left and 2 not in left and 9 not in left
