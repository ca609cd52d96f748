import pandas as pd

from fennec.llm import line_chunks as L
from fennec.llm.queries import QUERIES


def all_runs(rows):
    """Every run of lines of every length that occurs earlier: id -> (lines removed, text)."""
    docs = [(i, t.split("\n")) for i, t in sorted(rows)]
    number, seen, out = {}, set(), {}
    for ident, lines in docs:
        code = [number.setdefault(x, len(number)) for x in lines]
        gone = set()
        for s in range(len(lines)):
            chars = -1
            for e in range(s, len(lines)):
                chars += len(lines[e]) + 1
                if e - s + 1 >= L.MIN_LINES and chars >= L.MIN_CHARS:
                    key = tuple(code[s:e + 1])
                    if key in seen:
                        gone.update(range(s, e + 1))
                    seen.add(key)
        out[ident] = (len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else "\n".join(lines))
    return out


def test_boundaries_do_not_shift(spark):
    block = [f"line {i} of a block that is moved around in a text" for i in range(40)]
    texts = ["\n".join(block), "\n".join(["new", "lines", "before", *block, "after"]), "\n".join(["one", *block])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r["__removed"] for r in L.dedup_lines(df).collect()}
    assert got[0] == 0 and got[1] > 25 and got[2] > 25


def test_odd_rows(spark, odd_docs, no_docs):
    out = L.dedup_lines(odd_docs, min_chars=10, divisor=1)
    assert out.columns == [*odd_docs.columns, "__removed"]
    got = out.collect()
    assert len(got) == odd_docs.count() and all(r["__k"] == "x" and r.gone == 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[2][0].text == "" and by[3][0].text == "   \n\t "
    assert len({r.text for r in by[4]}) == 1
    assert L.dedup_lines(no_docs).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.text) for r in QUERIES["op9_line_chunks"](spark, sf).collect()}
    want = all_runs([(i, t) for i, t in zip(docs.doc_id, docs.text)])
    assert got == want and sum(x[0] for x in want.values()) > 0


def test_short_runs_amid_other_lines(spark):
    rows, ident = [], 0
    for n in (2, 3, 4, 5):
        for case in range(8):
            passage = [f"line {i} of the passage {n} {case} that two texts share" for i in range(n)]
            for _ in range(2):
                own = [f"text {ident} says in its line {i} what no other one says" for i in range(6)]
                rows.append((ident, "\n".join(own[:3] + passage + own[3:])))
                ident += 1
    got = {r.doc_id: r["__removed"] for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [got[i] for i in range(ident)] == [x for n in (2, 3, 4, 5) for _ in range(8) for x in (0, n)]
