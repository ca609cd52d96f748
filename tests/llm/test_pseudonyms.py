import datetime
import re

from pyspark.sql import functions as F

from fennec.llm import pseudonyms as P
from fennec.llm.queries import QUERIES

TEXTS = [
    "mail a.99@mail9.example.com from 10.0.0.1, then 1.2.3.4.",
    "card 4041894974608795 or 4041 8949 7460 8795 or 4041-8949-7460-8795!",
    "+1 (988) 555-2485 4041894974608795 10.0.0.1 (212) 555-1234 +49 30 1234567",
    "123-45-6789 2020-02-29 31.12.1999 2/30/2020 1/5/2021 2019/07/08 1899-01-01 000-12-3456 999.1.1.1",
    "DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 GB83WEST12345698765432 1234567890123",
    "", None, "plain words, 1 number and 12.5 more",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, kind string")
    return P.pseudonymise(df, "secret", **kw).orderBy("doc_id").collect()


def test_formats_are_kept_and_valid(spark):
    got = run(spark, TEXTS)
    t = [r.text for r in got]
    assert re.fullmatch(r"mail [a-z]\.\d\d@mail9\.example\.com from (\d{1,3}\.){3}\d{1,3}, then (\d{1,3}\.){3}\d{1,3}\.", t[0])
    assert all(int(x) < 256 for ip in re.findall(r"\d+(?:\.\d+){3}", t[0]) for x in ip.split("."))
    cards = re.fullmatch(r"card (\d{16}) or (\d{4} \d{4} \d{4} \d{4}) or (\d{4}-\d{4}-\d{4}-\d{4})!", t[1]).groups()
    assert len({re.sub(r"\D", "", c) for c in cards}) == 1 and luhn(re.sub(r"\D", "", cards[0]))
    assert cards[0] != "4041894974608795" and cards[0] in t[2]
    dates = re.findall(r"\d{4}-\d\d-\d\d", t[3])
    assert len(dates) == 2 and dates[1] == "1899-01-01" and datetime.date.fromisoformat(dates[0]) != datetime.date(2020, 2, 29)
    assert "2/30/2020" in t[3] and "000-12-3456" in t[3] and "999.1.1.1" in t[3]
    assert "GB83WEST12345698765432" in t[4] and t[4].endswith(" 1234567890123")
    for iban in re.findall(r"DE[\d ]+\d|GB\d\d[A-Z]{4}\d{14}", t[4])[:2]:
        s = iban.replace(" ", "")[:22]
        assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    assert t[5:] == TEXTS[5:]
    assert [got[3][f"n_{k}"] for k in P.KINDS] == [0, 0, 0, 4, 1, 0, 0]


def test_the_key_turns_them_back(spark):
    there = [r.text for r in run(spark, TEXTS)]
    assert there != TEXTS and [r.text for r in run(spark, there, inverse=True)] == TEXTS
    df = spark.createDataFrame([(0, TEXTS[0])], "doc_id int, text string")
    assert P.pseudonymise(df, "other").first().text != there[0]


def test_a_permutation_on_small_domains(spark):
    days = [f"{datetime.date(1900, 1, 1) + datetime.timedelta(d)}" for d in range(0, 73049, 61)]
    serials = [f"{a:03d}-{g:02d}-{s:04d}" for a, g, s in zip(range(1, 666, 3), [1, 50, 99] * 80, range(1, 9999, 40))]
    phones = [f"+1 (555) 010-{i:04d}" for i in range(0, 10000, 50)]
    for values in (days, serials, phones):
        got = [r.text for r in run(spark, values)]
        assert len(set(got)) == len(values) and all(len(a) == len(b) for a, b in zip(got, values))


def spellings(d):
    """Every spelling of a day: padded or not, month or day first."""
    yield f"{d:%Y-%m-%d}"
    yield f"{d:%Y/%m/%d}"
    for day in {str(d.day), f"{d:%d}"}:
        for month in {str(d.month), f"{d:%m}"}:
            yield f"{day}.{month}.{d.year}"
            yield f"{month}/{day}/{d.year}"
            if d.day > 12:
                yield f"{day}/{month}/{d.year}"


def read(text):
    a, b, c = map(int, re.split(r"\D", text))
    if a > 31:
        return datetime.date(a, b, c)
    return datetime.date(c, b, a) if "." in text or a > 12 else datetime.date(c, a, b)


def test_all_days_in_all_spellings(spark):
    first = datetime.date(P.FIRST_YEAR, 1, 1)
    days = [first + datetime.timedelta(i) for i in range((datetime.date(P.FIRST_YEAR + P.YEARS, 1, 1) - first).days)]
    assert sum(a * b for a, b in P.DATE_RADICES) == len(days)
    rows = [(s,) for i, d in enumerate(days) for s in (spellings(d) if i % 4 == 0 else [f"{d}"])]
    df = spark.createDataFrame(rows, "m string").repartition(8)
    once = df.withColumn("new", P.pseudonym(F.col("m"), P.kind_of(F.col("m")), "secret"))
    got = once.withColumn("back", P.pseudonym(F.col("new"), P.kind_of(F.col("new")), "secret", True)).collect()
    assert all(r.back == r.m for r in got)
    assert len({r.new for r in got}) == len(rows)
    iso = {r.m: r.new for r in got if r.m[4] == "-"}
    assert set(iso.values()) == {f"{d}" for d in days}
    assert all(f"{read(r.new)}" == iso[f"{read(r.m)}"] for r in got)  # a day has one pseudonym, in any spelling
    assert all(re.sub(r"\d", "0", r.m) == re.sub(r"\d", "0", r.new) for r in got)


def test_no_other_dates(spark):
    bad = ["1899-12-31", "2100-01-01", "1900-02-29", "2021-02-29", "30.2.2020", "0/5/2020", "13/13/2020", "1.13.2020", "2020-00-10"]
    assert [r.text for r in run(spark, bad)] == bad


def test_whole_table_and_odd_rows(spark, odd_docs, no_docs):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_pseudonyms"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    seen = 0
    for d in docs:
        for value in re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{16}\b", d.text or ""):
            if value.isdigit() and not luhn(value):
                assert value in got[d.doc_id].text  # not a card
                continue
            seen += 1
            assert value not in got[d.doc_id].text
        if not re.search(r"\d", d.text or ""):
            assert got[d.doc_id].text == d.text
    assert seen > 20
    odd = P.pseudonymise(odd_docs, "k").collect()
    assert sorted(str((r.doc_id, r.text)) for r in odd) == sorted(str((r.doc_id, r.text)) for r in odd_docs.collect())
    assert P.pseudonymise(no_docs, "k").count() == 0


def test_no_python_and_no_shuffle(spark):
    plan = QUERIES["op5_pseudonyms"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
