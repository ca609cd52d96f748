import hashlib
import random
import re

from fennec.llm import winnowing as W
from fennec.llm.queries import ORACLE, QUERIES

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP)) if w]


def brute(text, items):
    dw, hit, found = words(text), set(), set()
    for item, it in items:
        iw = words(it)
        n = min(13, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for p in range(len(dw) - n + 1) if n else ():
            if tuple(dw[p:p + n]) in wins:
                hit.update(range(p, p + n))
                found.add(str(item))
    return len(dw), len(hit), sorted(found)


def check(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int, __h string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in W.contamination(d, b, **kw).collect()]
    want = [(x[0], *brute(x[1], items)) for x in docs]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_random_texts_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 5, 8, 12, 13, 14, 30])))) for i in range(25)]
    items += [(90, None), (91, "!!"), (None, "w1 w2 w3 w1"), (92, items[0][1])]
    docs = []
    for i in range(80):
        ws = rng.choices(vocab, k=rng.randint(0, 60))
        if i % 2:
            src = words(rng.choice(items[:25])[1])
            at = rng.randint(0, len(ws))
            ws[at:at] = src[rng.randint(0, 2):]
        docs.append((i, " ".join(ws).upper() if i % 3 else ", ".join(ws), 7, "x"))
    docs += [(None, "w1", 1, "y"), (500, None, 1, "y"), (501, "", 1, None), (3, docs[3][1], 7, "x"), (502, " ".join(vocab * 3000), 1, "z")]
    items = [x for x in items if x[0] is not None]
    check(spark, docs, items)
    check(spark, docs, items, broadcast_rows=20)  # by a shuffle join


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "x")], "item_id bigint, text string")
    assert W.contamination(no_docs, some).count() == 0
    assert W.contamination(odd_docs, none).where("n_hit > 0").count() == 0
    assert W.contamination(odd_docs, some).where("n_hit > 0").count() == 1
    kept = W.decontaminate(odd_docs, some)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert kept.where("__k = 'x'").count() == kept.count()


def test_query_equals_its_sql(spark, duck):
    got = QUERIES["op2_decontamination"](spark, "/root/testdata/sf0.01")
    cols = got.columns
    want = duck.execute(ORACLE["op2_decontamination"])
    names = [c[0] for c in want.description]
    order = [names.index(c) for c in cols]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())
    assert got.where("n_items = 0").first().items_sha256 == hashlib.sha256(b"").hexdigest()


def test_runs_without_python(spark):
    df = QUERIES["op2_decontamination"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow", plan)


def test_texts_are_read_twice_whatever_the_item_lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in range(1, 16)], "item_id bigint, text string")
    for rows, join in ((1000, "BroadcastHashJoin"), (1, "SortMergeJoin")):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = W.contamination(docs, items, broadcast_rows=rows)
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert len(re.findall(r"FileScan parquet \[[^\]]*text", plan)) == 2 and join in plan
